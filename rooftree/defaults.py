"""Fixed values of the domain: word lists, thresholds, patterns, labels and column specs.

Everything here is data that results depend on.  All of it is passed to operators as a default
parameter value, so another language or market only needs other values.
"""
from __future__ import annotations

# --- sources and catalogs ---------------------------------------------------------------------
AGGREGATOR_PREFIX = "feed"
CATALOGS = ["apartments", "houses", "commercial"]
STICKY_STATUS = ["quarantine", "archived"]
STATUS_LABELS = {"active": "Актуальне", "inactive": "Неактуальне", "quarantine": "На перевірці", "archived": "Архів"}
STATUS_UNKNOWN = "На перевірці"
FLAT, HOUSE = "Квартира", "Будинок"

# --- prices -----------------------------------------------------------------------------------
RENT_MIN_UAH, BUY_MIN_USD = 20_000, 60_000
INTAKE_MIN_USD = {"rent": 2_000, "buy": 100_000}
FALLBACK_RATES = {"USD": 41.5, "EUR": 45.0}
CLEANUP_RATES = {"USD": 45.03, "EUR": 51.52}
RATE_CODES = {"USD": 840, "EUR": 978, "UAH": 980}

# --- districts, metro, region -----------------------------------------------------------------
DISTRICTS = ["Голосіївський", "Дарницький", "Деснянський", "Дніпровський", "Оболонський", "Печерський",
             "Подільський", "Святошинський", "Солом'янський", "Шевченківський"]
DISTRICT_ALIASES = {
    "Голосеевский": "Голосіївський", "Дарницкий": "Дарницький", "Деснянский": "Деснянський",
    "Днепровский": "Дніпровський", "Оболонский": "Оболонський", "Печерский": "Печерський",
    "Подольский": "Подільський", "Подол": "Подільський", "Святошинский": "Святошинський",
    "Соломенский": "Солом'янський", "Шевченковский": "Шевченківський"}
DISTRICT_TOKENS = {
    "Голосіївський": ["голосіїв", "голосеев"], "Дарницький": ["дарниц"], "Деснянський": ["деснян"],
    "Дніпровський": ["дніпров", "днепров"], "Оболонський": ["оболон"], "Печерський": ["печер"],
    "Подільський": ["поділ", "подол", "подільськ"], "Святошинський": ["святошин"],
    "Солом'янський": ["солом", "соломен"], "Шевченківський": ["шевченк"]}
METRO_STATIONS = [
    "Академмістечко", "Арсенальна", "Берестейська", "Бориспільська", "Васильківська", "Видубичі", "Вирлиця",
    "Виставковий центр", "Вокзальна", "Героїв Дніпра", "Гідропарк", "Голосіївська", "Дарниця", "Деміївська",
    "Дніпро", "Дорогожичі", "Житомирська", "Золоті ворота", "Звіринецька", "Іподром", "Кловська",
    "Контрактова площа", "Либідська", "Лісова", "Лівобережна", "Лук'янівська", "Майдан Незалежності", "Мінська",
    "Нивки", "Оболонь", "Олімпійська", "Осокорки", "Палац Україна", "Палац спорту", "Печерська",
    "Площа Українських Героїв", "Площа Льва Толстого", "Поштова площа", "Почайна", "Проспект Берестейський",
    "Славутич", "Сирець", "Тараса Шевченка", "Театральна", "Теремки", "Університет", "Харківська", "Хрещатик",
    "Чернігівська", "Червоний хутір", "Шулявська"]
CITY = "Київ"
REGION = "Київська область"
CITY_TOKENS = ["київ", "киев", "kyiv", "kiev", "голосіїв", "голосеев", "дарниц", "деснян", "дніпров", "днепров",
               "оболон", "печер", "поділ", "подол", "святошин", "солом", "шевченк"]
CITY_VETO = ["київська область", "киевская область"]
REGION_TOKENS = [
    "київська область", "киевская область", "київ обл", "киев обл", "біла церква", "белая церковь", "борисп",
    "бровар", "буч", "васильк", "вишгород", "ірпін", "ирпен", "обух", "переяслав", "фастів", "фастов", "яготин",
    "березань", "богуслав", "миронів", "миронов", "рокитн", "сквир", "теті", "тетієв", "узин", "славутич", "макар",
    "згурів", "бариш", "іванків", "иванков", "поліськ", "полес", "ставищ", "тарас", "володар", "кагар", "гостомел",
    "ворзель", "козин", "гнідин", "гнедин", "вишеньк", "білогород", "белогород", "боярк", "вишнев", "вишнево",
    "крюківщ", "крюковщ", "гатн", "хотів", "хотов", "лесник", "лісник", "горенич", "дмитрів", "дмитров", "петрівц",
    "петровц", "софіївська борщаг", "софиевская борщаг", "петропавлівська борщаг", "петропавловская борщаг",
    "щаслив", "гора", "проців", "процев", "ходосів", "ходосов", "тарасів", "тарасов", "глевах", "калинів",
    "калинов", "чабан", "клавдієв", "кладиев", "немішаєв", "немешаев", "михайлівка", "михайловка", "погреб",
    "зазим", "лебедів", "лебедев", "пухів", "пухов", "килів", "ржищ"]

# --- quality gate -----------------------------------------------------------------------------
HOUSE_TYPES = ["Будинок", "house", "будинок"]
# reason code -> SQL condition, in the order in which the first match wins
QUALITY_RULES = [
    ("rent_price_too_high", "operation = 'rent' AND price_uah > 500000"),
    ("rent_price_too_low", "operation = 'rent' AND price_uah < 20000"),
    ("buy_price_too_low", "operation = 'buy' AND price_usd < 60000"),
    ("buy_price_too_high", "operation = 'buy' AND price_usd > 5000000"),
    ("no_price", "price_uah IS NULL AND price_usd IS NULL"),
    ("rent_price_per_m2_anomaly",
     "operation = 'rent' AND area > 10 AND (price_uah / area < 150 OR price_uah / area > 6000)"),
    ("buy_price_per_m2_anomaly",
     "operation = 'buy' AND area > 10 AND (price_usd / area < 500 OR price_usd / area > 15000)"),
    ("area_rooms_mismatch", "rooms >= 3 AND area < 40"),
    ("area_too_small", "area < 11"),
    ("area_too_big", "area > 800"),
    ("floor_above_total", "floor > floors_total"),
    ("garbage_title",
     "length(trim(title)) < 10 OR lower(title) LIKE '%тест%' OR lower(title) LIKE '%test%'"),
    ("not_kyiv", "city NOT IN ('Київ', 'Киев', 'Kyiv', '') AND city NOT LIKE 'Київ%'"),
    ("not_apartment",
     "property_type NOT IN ('Квартира', 'apartment', 'квартира', 'Будинок', 'house', 'будинок', '')"),
]
RESTORABLE_REASONS = ["rent_price_too_high", "buy_price_too_low", "no_price", "price_anomaly_rent_high",
                      "price_below_filter", "price_anomaly_buy_high"]
RESTORE_UAH, RESTORE_USD = (20_000, 500_000), (60_000, 5_000_000)

# --- junk text and copy checks ----------------------------------------------------------------
JUNK_DESCRIPTIONS = ["опис", "описание", "description", "-", "--", "---", ".", "..", "...", "test", "тест",
                     "без опису", "немає опису"]
JUNK_PHRASES = ["Команда підтримки", "команда підтримки", "Будні з", "будні з", "Робочий час", "Вихідні з"]
JUNK_COPY_PHRASES = ["Команда підтримки", "[Назва", "[Адреса"]
JUNK_TITLE_WORDS = ["комісі", "брокер", "ріелтор", "агент"]
FALSE_COMMISSIONS = ["false", "none", "0", "no", "ні", "без", ""]
FALSE_AGENTS = ["unknown", "", "none", "None"]
PLACEHOLDER_TITLES = ["опис", "добре", "ок", "none", "null", "title", "назва"]
PLACEHOLDER_COPY = ["опис", "добре", "ок", "none", "null", "description"]
COPY_BANNED = (r"(комісі|ріелтор|риелтор|брокер|агент|власник|контакт|телефон|дзвон|звон|пишіть|звертайтеся|"
               r"не турбувати)")
BAD_TITLES = ["квартира", "продаж", "оренда", "житло", "нерухомість", "apartment", "sale", "rent", "flat", "test",
              "тест"]
SPAM_WORDS = ["комісія", "комиссия", "broker", "брокер", "call now", "зателефонуйте", "звоните", "срочно",
              "терміново"]

# --- redaction --------------------------------------------------------------------------------
PHONE_SHAPE = r"(?:\+?38)?[\s()\-]*0\d(?:[\s()\-]*\d){8,}"
URL_SHAPE = r"https?://\S+|www\.\S+"
PHONE_IN_TEXT = r"\+?38[\s()\-]*0\d(?:[\s()\-]*\d){8}|0\d(?:[\s()\-]*\d){8}"
PHONE_LOOSE = r"\+?\d[\d\s()\-]{8,}"
LEADING_LABEL = r"^(?:опис|описание|description)\s*[:\-–—]*\s*"
ENGLISH_MARKER = r"\*?\s*english\s+text"
BANNED = (r"комісі|ріелтор|риелтор|брокер|агент|власник|собственник|контакт|телефон|дзвон|звон|пишіть|звертайтеся|"
          r"не турбувати|без посеред")
REDACTIONS = [
    r"\b(?:без\s+)?комісі\w*\b",
    r"\b(?:від\s+)?(?:власник|собственник)\w*\b",
    r"\b(?:ріелтор|риелтор|брокер|агент)\w*(?:\s+[А-ЯІЇЄҐA-Z][\w'’.-]+){0,3}",
    r"\b(?:контакт|телефон|дзвон|дзвін|звон|пишіть|писати|звертайтеся|перепис|не\s+турбувати)\w*\b[^.!?\n]*",
    r"\b(?:viber|telegram|whatsapp|whatsup)\b[^.!?\n]*",
]
COMMERCIAL_BANNED = (r"комісі|ріелтор|риелтор|брокер|агент|агентств|власник|собственник|контакт|телефон|дзвон|дзвін|"
                     r"звон|пишіть|звертайтеся|не\s+турбувати|viber|telegram|whatsapp")
FACT_COMMISSION = r"\b(?:без\s+)?комісі\w*\b[^,.;!?]*"
FEED_CONTACT = (r"\b(?:телефон|дзвон|дзвін|пишіть|telegram|viber|whatsapp|агент|ріелтор|комісі\w*)\b[^.!?\n]*")
SENSITIVE_SENTENCE = (
    r"(?:\bolx\b|\brieltor\b|рієлтор|риелтор|\bагент\w*|\bвласник\w*|\bвладелец\w*|комісі|комисси|\bтелефон\w*|"
    r"\bзателеф\w*|\bдзвон\w*|whatsapp|telegram|\+?38[\s()\-]*0\d{2}[\s()\-]*\d{3}[\s()\-]*\d{2}[\s()\-]*\d{2})")
SENSITIVE_PARTS = ["olx", "rieltor", "рієлтор", "риелтор", "агент", "власник", "владелец", "комісі", "комисси", "телефон", "зателеф", "дзвон",
                   "whatsapp", "telegram", "38", *"\u0307\u0131\u017f\u1c80\u1c81\u1c82\u1c83\u1c84\u1c85"]
# each match of SENSITIVE_SENTENCE, in lower case, holds one of these: a word, or a letter that equals one of a word's without case only
TITLE_SUFFIX = r"\s*(?:[-–—]|\|)\s*(?:оголошення|объявление)\s*№?\s*\d+.*$"
MIN_SENTENCE = 12
FULL_HEAD = 500  # characters before a foreign-language marker that make a complete text
DETAILED_MIN = 180

# --- facts from prose -------------------------------------------------------------------------
AREA_UNIT = r"(?:м²|кв\.?\s*м|m²|м2)"
FLOOR_WORD = r"(?:поверх|этаж|етаж|пов\.?|эт\.?)"
ROOM_WORDS = [("однокімнат|однокомнат|студі", 1), ("двокімнат|двухкомнат", 2), ("трикімнат|трехкомнат", 3),
              ("чотирикімнат|четырехкомнат", 4)]
AGENT_OWNER_FIRST = [("owner", ["власник", "собственник", "хозяин", "без комісі", "без посередник"]),
                     ("agent", ["агент", "ріелтор", "риелтор"]),
                     ("agency", ["агентств", "компанія", "компания"])]
AGENT_AGENCY_FIRST = [("owner", ["власник", "собственник", "від власника"]),
                      ("agency", ["агентств", "агенство"]),
                      ("agent", ["ріелтор", "риелтор", "агент", "брокер"])]
AGENT_COMMERCIAL = [("owner", ["власник", "собственник"]), ("agency", ["агентств"]),
                    ("agent", ["рієлтор", "риелтор", "агент"])]
TYPE_SIGNAL = (
    r"^\s*(?:будин\w*|котедж\w*|таунхаус\w*|дуплекс\w*)\b|"
    r"\b(?:оренда|продаж|продається|здам|здається)[\s/:,-]+(?:будин\w*|котедж\w*|таунхаус\w*|дуплекс\w*)\b")
COMMISSION_UNKNOWN, COMMISSION_PENDING, COMMISSION_NONE = "Не вказано", "Комісія: умови уточнюються", "Без комісії"
COMMISSION_TERM = (
    r"(?:комісі\w*|комисс\w*|(?:агентськ\w*|агенці\w*)\s+послуг\w*|послуг\w*\s+(?:агентств\w*|агенці\w*)|"
    r"рі[еє]лторськ\w*\s+послуг\w*|брокерськ\w*\s+послуг\w*)")
COMMISSION_FREE = r"\b(?:без|безо)\s+(?:будь[- ]?якої\s+)?(?:комісі\w*|комисс\w*|посередник\w*)"
PERCENT_UNIT = r"(?:%|відсот(?:ок|ків)|процент\w*)"
MONEY_UNIT = r"(грн|₴|uah|usd|\$|дол(?:ар\w*)?|€|eur|євро)"

# --- commercial -------------------------------------------------------------------------------
COMMERCIAL_TYPES = [
    ("warehouse", ["склад", "логіст", "ангар"]), ("industrial", ["виробниц", "цех", "промислов"]),
    ("horeca", ["ресторан", "кафе", "бар", "ho.re.ca", "кухн"]), ("medical", ["стоматолог", "клінік", "медичн"]),
    ("office", ["офіс", "бізнес-центр", "бц "]), ("retail", ["магазин", "торгов", "шоурум", "фасад"]),
    ("hotel", ["готел", "hotel"]), ("building", ["окрема будів", "нежитлова будів"])]
COMMERCIAL_FLAGS = {
    "vat_included": ["пдв включ", "з пдв", "с ндс"], "utilities_included": ["комунальні включ", "коммунальные включ"],
    "separate_entrance": ["окремий вхід", "отдельный вход"], "facade": ["фасад", "фасадн"],
    "showcase_windows": ["вітрин", "витрин"], "loading_dock": ["док", "погрузочн"], "ramp": ["рамп"],
    "freight_elevator": ["вантажн", "грузов"], "electricity_backup": ["резервне живлення", "резервное питание"],
    "generator": ["генератор"], "water_supply": ["водопостач", "водоснабж"], "sewerage": ["каналіза", "канализац"],
    "ventilation": ["вентиляц"], "air_conditioning": ["кондиціон", "кондицион"],
    "fire_safety": ["пожежн", "пожарн"], "security": ["охорон", "сигналіза", "сигнализац"],
    "internet": ["інтернет", "интернет"]}
COMMERCIAL_NAMES = {  # type -> nominative, genitive
    "office": ("офісне приміщення", "офісного приміщення"), "retail": ("торгове приміщення", "торгового приміщення"),
    "warehouse": ("складське приміщення", "складського приміщення"),
    "industrial": ("виробниче приміщення", "виробничого приміщення"),
    "horeca": ("приміщення для HoReCa", "приміщення для HoReCa"),
    "medical": ("медичне приміщення", "медичного приміщення"), "hotel": ("готельний об’єкт", "готельного об’єкта"),
    "building": ("окрема будівля", "окремої будівлі"),
    "multifunctional": ("комерційне приміщення", "комерційного приміщення")}
COMMERCIAL_ALIASES = {"офіс": "office", "магазин": "retail", "склад": "warehouse", "виробництво": "industrial",
                      "horeca": "horeca", "медичне": "medical", "будівля": "building"}
MONEY_TOKEN = r"\$|usd|дол\.?|грн|uah|₴|€|eur"
SQUARE_UNIT = r"(?:м[²2]|m2|кв\.?\s*м)"
PERIOD_MARKS = [("month", ["/міс", "/ міся", "за міся", "в міся", "на міся", "per month", "/month"]),
                ("day", ["/день", "/ день", "за доб", "на доб", "per day"]),
                ("year", ["/рік", "/ рік", "за рік", "на рік", "per year"])]
TOTAL_AREA_LABELS = ["загальна площа", "загальна", "повна площа", "площа приміщення"]
USABLE_AREA_LABELS = ["корисна площа", "орендна площа", "орендована площа", "робоча площа", "usable", "rentable"]

# --- photos -----------------------------------------------------------------------------------
PHOTO_REJECT = (r"(?:avatars?|profile|userpic|agent[-_]?photo|realtor[-_]?avatar|logo|brand|placeholder|"
                r"default[-_]?image|120/120|120x120)")
PHOTO_PREFER = r"(?:/offers/|offers/|houses-photos|market-images|apollo\.olxcdn\.com|/gallery/|/listing)"

# --- site rules: url marker, id pattern, id prefix, display pattern ---------------------------
SITE_RULES = [("olx", r"ID([a-zA-Z0-9]+)\.html", "olx_"), ("rieltor", r"/view/(\d+)", "rieltor_")]
DISPLAY_RULES = [("olx", r"\b(ID[A-Za-z0-9]+)\.html", "olx_"),
                 ("rieltor", r"/(\d+)/?(?:[?#].*)?$", "rieltor_")]
TEL_HREF = r"<a\b[^>]*\bhref\s*=\s*['\"]\s*tel:([^'\"?#<]+)"
AD_ID_PATTERNS = [r'"ad_id"\s*:\s*"?(\d+)"?', r'"id"\s*:\s*(\d+)', r'data-ad-id="(\d+)"', r'"list_id"\s*:\s*"?(\d+)"?']

# --- jobs and failures ------------------------------------------------------------------------
MAX_ATTEMPTS = 6
LISTING_RETRY_CODES = [403, 429, 500, 502, 503, 504]
PHONE_RETRY_CODES = [401, 403, 429, 500, 502, 503, 504]
RETRY_MINUTES = {"listing": 30, "phone": 45, "exception": 60}
TRANSIENT_MARKERS = ["httpx.", "requestserror", "connection reset", "connection aborted", "connecterror", "timeout",
                     "temporarily unavailable", "can't assign requested address", "too many requests", "429"]

# --- snapshots --------------------------------------------------------------------------------
CORE_FIELDS = ["rooms", "area", "district", "street", "metro_station", "photo_url", "description"]
COMPLETENESS_FIELDS = ["title", "description", "price_uah", "price_usd", "price_eur", "area", "district", "city",
                       "photo_url"]
FINGERPRINT_FIELDS = ["title", "ai_title", "description", "ai_description", "price_uah", "price_usd", "price_eur",
                      "area", "area_total_m2", "floor", "floors_total", "rooms", "street", "full_address",
                      "updated_at"]
APARTMENT_MERGE = {
    "operation": "overwrite", "property_type": "non_blank", "title": "non_blank", "description": "non_blank",
    "price_uah": "non_null", "price_usd": "non_null", "price_eur": "non_null", "area": "non_null",
    "floor": "non_null", "floors_total": "non_null", "rooms": "non_null", "district": "non_blank",
    "city": "non_blank", "street": "non_blank", "metro_station": "non_blank", "residential_complex": "non_blank",
    "commission": "non_blank", "url": "overwrite", "photo_url": "non_blank", "photos": "non_empty",
    "agent_type": "unless_unknown", "agent_name": "non_blank", "agent_phone": "non_blank", "status": "sticky",
    "parsed_at": "overwrite", "updated_at": "asof"}
HOUSE_MERGE_KEEP = {"agent_phone": "non_blank", "contact_phone": "non_blank", "status": "sticky",
                    "created_at": "keep", "updated_at": "asof"}
COMMENT_DUPLICATE_URL, COMMENT_DUPLICATE_PRINT = "duplicate_url:", "duplicate_fingerprint:"
FLOOR_NOTE = "quality: invalid floor values cleared"
TEXT_PHONE_NOTE = "contact: public phone extracted from text"
ABSENCE_NOTE = "inactive after two complete collections"

# --- labels of publication facts: field, suffix, local label, English label ------------------
FACT_LABELS = [
    ("price_uah", "UAH", "Ціна", "Price"), ("price_usd", "USD", "Ціна", "Price"), ("price_eur", "EUR", "Ціна", "Price"),
    ("area", "m²", "Загальна площа", "Total area"), ("floor", "", "Поверх", "Floor"),
    ("floors_total", "", "Поверхів", "Total floors"), ("rooms", "", "Кімнат", "Rooms"),
    ("district", "", "Район", "District"), ("address", "", "Адреса", "Address")]
FACT_LABELS_COMMERCIAL = [
    ("commercial_kind", "", "Тип", "Type"), ("ceiling_height_m", "m", "Висота стелі", "Ceiling height"),
    ("electric_power_kw", "kW", "Потужність", "Power")]

# --- display grid -----------------------------------------------------------------------------
GRID_HEADERS = [
    "ID", "Ext ID", "Фото", "Source", "Operation", "Property Type", "URL", "Title", "AI Title", "Description",
    "AI Description", "UAH", "USD", "EUR", "Rooms", "Area", "Floor", "Floors Total", "District", "City", "Street",
    "Residential Complex", "Metro", "Agent Type", "Agent Name", "Agent Phone", "Commission", "Created At",
    "Updated At", "Коментарі", "Telegraph UA", "Telegraph EN"]
# Cell widths of the published sheet, by column; ids are never cut.
GRID_WIDTHS = {
    "external_id": 40, "source": 20, "operation": 10, "property_type": 500, "url": 500, "title": 300, "ai_title": 200,
    "description": 49_000, "ai_description": 49_000, "rooms": 5, "area": 10, "floor": 5, "floors_total": 5, "district": 50,
    "city": 500, "street": 100, "residential_complex": 80, "metro_station": 50, "agent_type": 30, "agent_name": 80,
    "agent_phone": 50, "commission": 50, "created_at": 19, "updated_at": 19, "comments": 100}

# --- page blocks --------------------------------------------------------------------------------
# Block -> rules (tag, attribute, comparison, value[, inner tag]) of the sites' markup.
BOARD_BLOCKS = {
    "price": [("h3", "class", "*=", "price")], "params": [("li", "class", "*=", "param"), ("p", "class", "*=", "css-odhutu")],
    "description": [("div", "data-cy", "=", "ad_description"), ("div", "class", "*=", "description")],
    "location": [("p", "class", "*=", "location")], "seller": [("div", "class", "*=", "user-info"), ("h4", "class", "*=", "seller")],
    "photos": [("div", "class", "*=", "photo"), ("div", "class", "*=", "swiper")]}
AGENCY_BLOCKS = {
    "price": [("div", "class", "~=", "offer-view-price-title"), ("div", "class", "~=", "offer-view-price")],
    "params": [("div", "class", "~=", "offer-view-details-row")], "description": [("div", "class", "~=", "offer-view-section-text")],
    "street": [("div", "class", "~=", "offer-view-address")], "location": [("div", "class", "~=", "offer-view-address-line")],
    "region": [("div", "class", "~=", "offer-view-region")], "seller": [("a", "class", "~=", "offer-view-rieltor-name")],
    "position": [("div", "class", "~=", "offer-view-rieltor-position")], "phones": [("div", "class", "~=", "offer-view-rieltor-phones")],
    "labels": [("div", "class", "~=", "offer-view-labels")], "agency": [("a", "class", "~=", "offer-view-rieltor-agency-link")],
    "photos": [("div", "class", "~=", "offer-view-gallery"), ("div", "class", "*=", "offer-photo-gallery")]}
COMMERCIAL_BOARD_BLOCKS = {
    "price": [("h3", "class", "*=", "price"), ("div", "data-testid", "=", "ad-price-container", "h3")],
    "params": [("li", "class", "*=", "param", "p"), ("ul", "class", "*=", "params", "li"), ("*", "data-testid", "*=", "parameter", "p")],
    "description": [("div", "data-cy", "=", "ad_description", "div"), ("div", "class", "*=", "description")],
    "location": [("a", "href", "*=", "map", "span"), ("p", "class", "*=", "location")],
    "seller": [("div", "class", "*=", "user-info", "a"), ("h4", "class", "*=", "seller")]}
COMMERCIAL_AGENCY_BLOCKS = {
    "title": [("h1", "class", "*=", ""), ("span", "class", "~=", "offer-photo-gallery__title")],
    "price": [("div", "class", "~=", "offer-view-price-title"), ("div", "class", "~=", "offer-view-price")],
    "address": [("div", "class", "~=", "offer-view-address"), ("div", "class", "~=", "offer-view-address-line")],
    "region": [("div", "class", "~=", "offer-view-region")], "description": [("div", "class", "~=", "offer-view-section-text")],
    "details": [("div", "class", "~=", "offer-view-details-row")], "name": [("a", "class", "~=", "offer-view-rieltor-name")],
    "position": [("div", "class", "~=", "offer-view-rieltor-position")], "agency": [("a", "class", "~=", "offer-view-rieltor-agency-link")],
    "phones": [("div", "class", "~=", "offer-view-rieltor-phones")]}
COMMERCIAL_STREET = r"(?<![\wіїєґ])((?:вул(?:иця)?\.?|ул\.?|просп(?:ект)?\.?|бульв(?:ар)?\.?|пров(?:улок)?\.?)\s*[^,\n|/()]{2,100})"

# --- display grids of the other catalogs --------------------------------------------------------
# Headers of the commercial sheet, in order.
COMMERCIAL_HEADERS = [
    "ID", "Ext ID", "Фото", "Джерело", "Операція", "Статус", "Тип комерції", "Підтип", "URL",
    "Заголовок", "AI заголовок", "Опис", "AI опис",
    "Ціна за приміщення, грн", "Ціна за приміщення, $", "Ціна за приміщення, €", "Період ціни", "Ціна за м², грн", "Ціна за м², $", "Ціна за м², €", "Період ціни за м²",
    "Площа, м²", "Корисна площа, м²", "Поверх", "Висота стелі, м", "Район", "Місто", "Вулиця", "Повна адреса",
    "Призначення", "Стан", "Планування", "Потужність, кВт",
    "Генератор", "Резервне живлення", "Вентиляція", "Кондиціонування", "Фасад", "Окремий вхід", "Вітрини",
    "Рампа", "Док", "Паркомісць", "Хто розміщує", "Ім'я", "Агенція", "Телефони", "Комісія",
    "ПДВ включено", "OPEX", "Комунальні включено", "Створено", "Оновлено", "Розібрано", "Помилки валідації", "Коментарі"]
# Widths of the commercial and of the house sheet's cells, by column.
COMMERCIAL_WIDTHS = {
    "id": 30, "external_id": 60, "photo_url": 1_000, "source": 30, "commercial_type": 80, "commercial_subtype": 100, "url": 1_000, "title": 500, "ai_title": 500,
    "description": 49_000, "ai_description": 49_000, "price_period": 20, "price_per_m2_period": 20, "floor_label": 80, "district": 100, "city": 50, "street": 160,
    "full_address": 300, "permitted_use": 300, "condition": 100, "layout_type": 100, "advertiser_type": 40, "contact_name": 100, "agency_name": 160, "phones": 300,
    "commission_text": 120, "created_at": 40, "updated_at": 40, "parsed_at": 40, "validation_errors": 500, "comments": 1_000}
HOUSE_COLUMNS = [
    "id", "external_id", "photo_url", "source", "operation", "property_type", "url", "title", "ai_title", "description", "ai_description", "price_uah", "price_usd", "price_eur",
    "rooms", "area", "floor", "floors_total", "district", "city", "street", "residential_complex", "metro_station", "agent_type", "agent_name", "agent_phone", "commission",
    "created_at", "updated_at", "comments"]
HOUSE_WIDTHS = {c: 49_000 if c in ("description", "ai_description") else 500 for c in HOUSE_COLUMNS}
