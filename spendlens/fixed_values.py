"""Word lists, patterns, tables and thresholds.

Everything in this module is data that results depend on, so each value is
written out as plain text. No logic lives here beyond reading the text tables.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Source columns
# --------------------------------------------------------------------------
REQUIRED_COLUMNS = ["CUST_NUM", "MCHT_NM", "TXN_AMT", "TXN_DT"]
OPTIONAL_COLUMNS = [
    "TXN_DESC", "CURR_DESC", "ONLN_FLAG", "MCHT_CATG", "MCHT_SUB_CATG",
    "SIC_CD_DESC", "MCC_CD", "CNTRY_CD", "TXN_CURR_CD",
]

# --------------------------------------------------------------------------
# Merchant text clean-up, applied top to bottom
# --------------------------------------------------------------------------
CLEANUP_STEPS = [
    (r"[*#@!{}]+", " "),
    (r"\s+", " "),
    (r"\b(branch|br|stn|station|outlet|kiosk)\s*\d*\b", ""),
    (r"\b(bangkok|bkk|chiang\s?mai|phuket|pattaya|hat\s?yai|korat|khon\s?kaen|udon|thailand|th)\s*$", ""),
    (r"\b\d{5,}\b", ""),
    (r"\s+", " "),
]
BASIC_CLEANUP_STEPS = [
    (r"[^a-z0-9ก-๙\s\*\-\./&]", " "),
    (r"\s+", " "),
]

# --------------------------------------------------------------------------
# Pattern lists (regular expressions, any one may match)
# --------------------------------------------------------------------------
TOPUP = [
    "truemoney", "true money", "rabbit line pay", "linepay", "line pay",
    "shopeepay", "blueplus", "wallet topup", "wallet top-up", "topup", "top-up",
    "เติมเงิน", "reload", "cash in", "purchase/load", "funding transaction",
    "poi funding", "stored value",
]
WALLET = [
    "truemoney", "true money", "rabbit line pay", "linepay", "line pay",
    "shopeepay", "blueplus", "promptpay", "grabpay", "grab pay", "airpay",
    "dolfin", "kplus", r"k\+", "scb easy", "samsung pay", "apple pay",
    "google pay",
]
PROCESSOR = ["paypal", "stripe", "adyen", "worldpay", "2c2p", "omise", "opn payments"]
IN_APP = [
    "grab", "lineman", "line man", "foodpanda", "shopee", "lazada", "truemoney",
    "linepay", "rabbit line pay", "netflix", "spotify", "robinhood",
]
FOOD_DELIVERY = ["grabfood", "grab food", "foodpanda", "lineman", "line man", "robinhood"]
RIDE_HAILING = [r"grab(?!food|\s?food)", "bolt", "grabcar", "grabtaxi", "indriver"]
SUBSCRIPTION = [
    "netflix", "spotify", "youtube premium", "disney", "hbo", "viu", "wetv",
    "iqiyi", "true id", "ais play", "apple music", "joox", "adobe", "canva",
    "figma", "microsoft 365", "ms 365", "icloud",
]
RISKY = [
    "casino", "gambling", r"\bbet\b", r"\bslot\b", "lottery", "crypto", "forex",
    "binary option", "pawn shop", "escort", "adult",
]
GROCERY = [
    "big c", "bigc", "lotus", "tesco", "tops market", r"\btops\b", "makro",
    "gourmet market", "villa market", "foodland", "cp fresh", "maxvalu",
]
MALL = [
    "central world", "central plaza", "central festival", "the mall",
    "terminal 21", "fashion island", "mega bangna", "future park", "seacon",
    "jungceylon", "westgate", "iconsiam", "paragon", "emporium", "emquartier",
]
PREMIUM_BRAND = [
    "louis vuitton", "gucci", "prada", "chanel", "hermes", "dior", "burberry",
    "bottega", "balenciaga", "ysl", "saint laurent", "cartier", "tiffany",
    "bvlgari", "omega", "rolex",
]
DOMESTIC_CURRENCY = "(?i)thb|baht|764"

# Platform labels, first match wins
PLATFORMS = [
    ("GRAB_PLATFORM", r"grab|grabfood|grabtaxi|grabcar|grabpay|grab\s?(express|mart|reward)"),
    ("LINE_PLATFORM", r"line|lineman|linepay|line\s?(man|pay|sticker|tv|game|webtoon)|rabbit\s?line"),
    ("SHOPEE_PLATFORM", r"shopee|shopeepay|shopee\s?(pay|mall|food)"),
    ("TRUE_PLATFORM", r"true|truemoney|true\s?(money|move|coffee|id|online|vision|wallet)"),
    ("LAZADA_PLATFORM", "lazada"),
    ("ROBINHOOD_PLATFORM", "robinhood"),
    ("KBANK_PLATFORM", r"\bkbank\b|k\s?plus|kplus|k\+"),
]

# --------------------------------------------------------------------------
# Category sets behind the taxonomy-based flags
# --------------------------------------------------------------------------
PREMIUM_L3 = ["LUXURY_FASHION_BRANDS", "FINE_DINING", "SIAM_EM_DISTRICT", "ICONSIAM"]
TRAVEL_BOOKING_L2 = ["AIRLINES", "HOTELS", "OTA_TRAVEL"]

# --------------------------------------------------------------------------
# Tiers, upper bound exclusive
# --------------------------------------------------------------------------
SIZE_TIERS = [("MICRO", 100), ("SMALL", 500), ("STANDARD", 2000), ("MID", 10000), ("LARGE", 50000)]
SIZE_TIER_TOP = "PREMIUM"
HOUR_PATTERNS = [
    ("MORNING_ROUTINE", 6, 9), ("LATE_MORNING", 9, 12), ("LUNCH", 12, 14),
    ("AFTERNOON", 14, 17), ("EVENING_SOCIAL", 17, 22),
]
HOUR_PATTERN_REST = "LATE_NIGHT"
LARGE_TOPUP = 10000

# --------------------------------------------------------------------------
# Taxonomy (L1, L2, L3)
# --------------------------------------------------------------------------
HIERARCHY = [
    ("EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "RETAIL_GROCERY_MODERN"),
    ("EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "PREMIUM_GROCERY"),
    ("EVERYDAY_ESSENTIALS", "CONVENIENCE_STORE", "CONVENIENCE_CHAIN"),
    ("EVERYDAY_ESSENTIALS", "WHOLESALE", "WHOLESALE_CLUB"),
    ("EVERYDAY_ESSENTIALS", "PHARMACY_DRUGSTORE", "PHARMACY_CHAIN"),
    ("EVERYDAY_ESSENTIALS", "UTILITIES", "WATER_ELECTRIC_GAS"),
    ("EVERYDAY_ESSENTIALS", "FUEL", "FUEL_STATION"),
    ("FOOD_DINING", "RESTAURANTS", "THAI_CHAIN_RESTAURANTS"),
    ("FOOD_DINING", "RESTAURANTS", "INTERNATIONAL_CHAIN"),
    ("FOOD_DINING", "RESTAURANTS", "FINE_DINING"),
    ("FOOD_DINING", "FAST_FOOD_QSR", "FAST_FOOD_CHAIN"),
    ("FOOD_DINING", "COFFEE_CAFE", "COFFEE_CHAINS"),
    ("FOOD_DINING", "COFFEE_CAFE", "INDEPENDENT_CAFE"),
    ("FOOD_DINING", "FOOD_DELIVERY", "FOOD_DELIVERY_APP"),
    ("FOOD_DINING", "BAKERY_DESSERT", "BAKERY_CHAIN"),
    ("TRAVEL_MOBILITY", "RIDE_HAILING", "RIDE_HAILING_APP"),
    ("TRAVEL_MOBILITY", "PUBLIC_TRANSPORT", "BTS_MRT_BUS"),
    ("TRAVEL_MOBILITY", "TOLL_PARKING", "EXPRESSWAY_TOLL"),
    ("TRAVEL_MOBILITY", "TOLL_PARKING", "PARKING"),
    ("TRAVEL_MOBILITY", "AIRLINES", "DOMESTIC_AIRLINE"),
    ("TRAVEL_MOBILITY", "AIRLINES", "INTERNATIONAL_AIRLINE"),
    ("TRAVEL_MOBILITY", "HOTELS", "HOTEL_CHAIN"),
    ("TRAVEL_MOBILITY", "HOTELS", "BOUTIQUE_HOTEL"),
    ("TRAVEL_MOBILITY", "OTA_TRAVEL", "OTA_PLATFORM"),
    ("TRAVEL_MOBILITY", "OTA_TRAVEL", "ACTIVITY_BOOKING"),
    ("SHOPPING_RETAIL", "MALLS_DEPARTMENT", "CENTRAL_GROUP_MALLS"),
    ("SHOPPING_RETAIL", "MALLS_DEPARTMENT", "THE_MALL_GROUP"),
    ("SHOPPING_RETAIL", "MALLS_DEPARTMENT", "SIAM_EM_DISTRICT"),
    ("SHOPPING_RETAIL", "MALLS_DEPARTMENT", "MEGA_MALLS"),
    ("SHOPPING_RETAIL", "MALLS_DEPARTMENT", "DEPARTMENT_STORES"),
    ("SHOPPING_RETAIL", "MALLS_DEPARTMENT", "ICONSIAM"),
    ("SHOPPING_RETAIL", "FASHION", "COMMON_FASHION_BRANDS"),
    ("SHOPPING_RETAIL", "FASHION", "LUXURY_FASHION_BRANDS"),
    ("SHOPPING_RETAIL", "FASHION", "SPORTSWEAR"),
    ("SHOPPING_RETAIL", "ELECTRONICS", "ELECTRONICS_RETAIL"),
    ("SHOPPING_RETAIL", "BOOKS_STATIONERY", "BOOKSTORE_CHAIN"),
    ("SHOPPING_RETAIL", "GIFTS_HOBBY_TOYS", "SPECIALITY_GIFTSHOP"),
    ("SHOPPING_RETAIL", "GIFTS_HOBBY_TOYS", "TOY_HOBBY"),
    ("SHOPPING_RETAIL", "MARKETPLACE_ECOM", "MARKETPLACE_PLATFORM"),
    ("SHOPPING_RETAIL", "VARIETY_HOME", "VARIETY_STORE"),
    ("HEALTH_WELLNESS", "HOSPITAL_CLINIC", "HOSPITAL_PRIVATE"),
    ("HEALTH_WELLNESS", "HOSPITAL_CLINIC", "CLINIC"),
    ("HEALTH_WELLNESS", "BEAUTY_WELLNESS", "BEAUTY_RETAIL"),
    ("HEALTH_WELLNESS", "BEAUTY_WELLNESS", "SPA_WELLNESS"),
    ("HEALTH_WELLNESS", "FITNESS_GYM", "GYM_FITNESS"),
    ("DIGITAL_SERVICES", "STREAMING", "STREAMING_CONTENT"),
    ("DIGITAL_SERVICES", "STREAMING", "MUSIC_STREAMING"),
    ("DIGITAL_SERVICES", "GAMING", "GAMING_PLATFORM"),
    ("DIGITAL_SERVICES", "SAAS_BIG_TECH", "GOOGLE_ECOSYSTEM"),
    ("DIGITAL_SERVICES", "SAAS_BIG_TECH", "META_ECOSYSTEM"),
    ("DIGITAL_SERVICES", "SAAS_BIG_TECH", "MICROSOFT_ECOSYSTEM"),
    ("DIGITAL_SERVICES", "SAAS_BIG_TECH", "APPLE_ECOSYSTEM"),
    ("DIGITAL_SERVICES", "TELCO_MOBILE", "TELCO_MOBILE_PROVIDER"),
    ("DIGITAL_SERVICES", "TELCO_BROADBAND", "TELCO_BROADBAND_PROVIDER"),
    ("ENTERTAINMENT_LEISURE", "CINEMA", "CINEMA_CHAIN"),
    ("ENTERTAINMENT_LEISURE", "ATTRACTIONS", "THEME_PARK"),
    ("ENTERTAINMENT_LEISURE", "ATTRACTIONS", "MUSEUM_ZOO"),
    ("ENTERTAINMENT_LEISURE", "SPORTS_ACTIVITY", "SPECIALITY_SPORT"),
    ("ENTERTAINMENT_LEISURE", "SPORTS_ACTIVITY", "GOLF"),
    ("EDUCATION", "SCHOOL_UNIVERSITY", "UNIVERSITY"),
    ("EDUCATION", "SCHOOL_UNIVERSITY", "SCHOOL"),
    ("EDUCATION", "TUTORING_LANGUAGE", "TUTORING_CENTER"),
    ("HOME_LIVING", "HOME_IMPROVEMENT", "HOME_IMPROVEMENT_STORE"),
    ("HOME_LIVING", "FURNITURE_HOME", "FURNITURE_STORE"),
    ("AUTOMOTIVE", "VEHICLE_SERVICE", "CAR_SERVICE"),
    ("AUTOMOTIVE", "CAR_RENTAL", "CAR_RENTAL_AGENCY"),
    ("FINANCIAL_SERVICES", "DIGITAL_WALLET_TOPUP", "TRUEMONEY"),
    ("FINANCIAL_SERVICES", "DIGITAL_WALLET_TOPUP", "LINEPAY"),
    ("FINANCIAL_SERVICES", "DIGITAL_WALLET_TOPUP", "SHOPEEPAY"),
    ("FINANCIAL_SERVICES", "PAYMENT_PROCESSORS", "PAYMENT_PROCESSOR"),
    ("FINANCIAL_SERVICES", "INSURANCE", "INSURANCE_PAYMENTS"),
    ("FINANCIAL_SERVICES", "INVESTMENT_TRADING", "TRADING_PLATFORM"),
    ("B2B_PROFESSIONAL", "GOVERNMENT", "GOVERNMENT_SERVICE"),
    ("B2B_PROFESSIONAL", "PROFESSIONAL_SERVICES", "OFFICE_SUPPLY"),
    ("B2B_PROFESSIONAL", "PROFESSIONAL_SERVICES", "COURIER_LOGISTICS"),
    ("OTHER_LONGTAIL", "UNCLASSIFIED", "UNCLASSIFIED"),
]

# Spend ecosystems with their own mart columns
ECOSYSTEMS = [
    "EVERYDAY_ESSENTIALS", "FOOD_DINING", "TRAVEL_MOBILITY", "SHOPPING_RETAIL",
    "HEALTH_WELLNESS", "DIGITAL_SERVICES", "ENTERTAINMENT_LEISURE", "EDUCATION",
    "HOME_LIVING", "AUTOMOTIVE", "FINANCIAL_SERVICES", "B2B_PROFESSIONAL",
]
UNCLASSIFIED = "UNCLASSIFIED"
OTHER_LONGTAIL = "OTHER_LONGTAIL"

# L2 categories with their own mart columns
KEY_L2 = [
    "GROCERY_MODERN", "CONVENIENCE_STORE", "FUEL", "WHOLESALE", "RESTAURANTS",
    "FAST_FOOD_QSR", "COFFEE_CAFE", "FOOD_DELIVERY", "MARKETPLACE_ECOM",
    "MALLS_DEPARTMENT", "FASHION", "STREAMING", "AIRLINES", "HOTELS", "OTA_TRAVEL",
    "HOSPITAL_CLINIC", "BEAUTY_WELLNESS", "HOME_IMPROVEMENT",
    "DIGITAL_WALLET_TOPUP", "TELCO_MOBILE", "ELECTRONICS",
]

# --------------------------------------------------------------------------
# Merchant rules by priority (lowest wins)
# (priority, rule_name, regex_pattern, L1, L2, L3)
# --------------------------------------------------------------------------
MERCHANT_RULES = [
    (1, "TRUEMONEY", r"truemoney|true money|true\s?wallet", "FINANCIAL_SERVICES", "DIGITAL_WALLET_TOPUP", "TRUEMONEY"),
    (2, "LINEPAY", "rabbit line pay|linepay|line pay", "FINANCIAL_SERVICES", "DIGITAL_WALLET_TOPUP", "LINEPAY"),
    (3, "SHOPEEPAY", r"shopeepay|shopee\s?pay", "FINANCIAL_SERVICES", "DIGITAL_WALLET_TOPUP", "SHOPEEPAY"),
    (4, "BLUEPAY", r"blueplus|blue\s?pay", "FINANCIAL_SERVICES", "DIGITAL_WALLET_TOPUP", "TRUEMONEY"),
    (5, "PAYPAL", "paypal", "FINANCIAL_SERVICES", "PAYMENT_PROCESSORS", "PAYMENT_PROCESSOR"),
    (6, "STRIPE", "stripe|adyen|worldpay|2c2p|omise", "FINANCIAL_SERVICES", "PAYMENT_PROCESSORS", "PAYMENT_PROCESSOR"),
    (7, "PROMPTPAY", r"promptpay|prompt\s?pay", "FINANCIAL_SERVICES", "DIGITAL_WALLET_TOPUP", "TRUEMONEY"),
    (10, "GRABFOOD", r"grabfood|grab\s?food", "FOOD_DINING", "FOOD_DELIVERY", "FOOD_DELIVERY_APP"),
    (11, "FOODPANDA", r"foodpanda|food\s?panda", "FOOD_DINING", "FOOD_DELIVERY", "FOOD_DELIVERY_APP"),
    (12, "LINEMAN", r"lineman|line\s?man", "FOOD_DINING", "FOOD_DELIVERY", "FOOD_DELIVERY_APP"),
    (13, "ROBINHOOD_FD", "robinhood", "FOOD_DINING", "FOOD_DELIVERY", "FOOD_DELIVERY_APP"),
    (20, "GRAB_RIDE", r"grab(?!food|\s?food)", "TRAVEL_MOBILITY", "RIDE_HAILING", "RIDE_HAILING_APP"),
    (21, "BOLT", r"bolt\s?(ride|taxi)?", "TRAVEL_MOBILITY", "RIDE_HAILING", "RIDE_HAILING_APP"),
    (22, "BTS", r"bts|skytrain|sky\s?train", "TRAVEL_MOBILITY", "PUBLIC_TRANSPORT", "BTS_MRT_BUS"),
    (23, "MRT", r"\bmrt\b", "TRAVEL_MOBILITY", "PUBLIC_TRANSPORT", "BTS_MRT_BUS"),
    (24, "EXPRESSWAY", r"expressway|tollway|toll\s?way|exat", "TRAVEL_MOBILITY", "TOLL_PARKING", "EXPRESSWAY_TOLL"),
    (25, "EASY_PASS", r"easy\s?pass", "TRAVEL_MOBILITY", "TOLL_PARKING", "EXPRESSWAY_TOLL"),
    (30, "SHOPEE", r"shopee(?!pay|\s?pay)", "SHOPPING_RETAIL", "MARKETPLACE_ECOM", "MARKETPLACE_PLATFORM"),
    (31, "LAZADA", "lazada", "SHOPPING_RETAIL", "MARKETPLACE_ECOM", "MARKETPLACE_PLATFORM"),
    (32, "AMAZON", "amazon|amzn", "SHOPPING_RETAIL", "MARKETPLACE_ECOM", "MARKETPLACE_PLATFORM"),
    (33, "ALIEXPRESS", r"aliexpress|ali\s?express|alibaba", "SHOPPING_RETAIL", "MARKETPLACE_ECOM", "MARKETPLACE_PLATFORM"),
    (34, "JD_CENTRAL", r"jd\s?central|jd\.co", "SHOPPING_RETAIL", "MARKETPLACE_ECOM", "MARKETPLACE_PLATFORM"),
    (35, "TIKTOK_SHOP", r"tiktok\s?shop", "SHOPPING_RETAIL", "MARKETPLACE_ECOM", "MARKETPLACE_PLATFORM"),
    (40, "NETFLIX", "netflix", "DIGITAL_SERVICES", "STREAMING", "STREAMING_CONTENT"),
    (41, "SPOTIFY", "spotify", "DIGITAL_SERVICES", "STREAMING", "MUSIC_STREAMING"),
    (42, "YOUTUBE", r"youtube|google\*youtube", "DIGITAL_SERVICES", "STREAMING", "STREAMING_CONTENT"),
    (43, "DISNEY_PLUS", r"disney\+|disney\s?plus|hotstar", "DIGITAL_SERVICES", "STREAMING", "STREAMING_CONTENT"),
    (44, "HBO", r"hbo|hbo\s?go", "DIGITAL_SERVICES", "STREAMING", "STREAMING_CONTENT"),
    (45, "APPLE_DIGITAL", r"apple\.com|itunes|app\s?store", "DIGITAL_SERVICES", "SAAS_BIG_TECH", "APPLE_ECOSYSTEM"),
    (46, "GOOGLE_PLAY", r"google\s?(play|one|cloud|storage)", "DIGITAL_SERVICES", "SAAS_BIG_TECH", "GOOGLE_ECOSYSTEM"),
    (47, "GOOGLE_ADS", r"google\s?(ads|adwords)", "B2B_PROFESSIONAL", "PROFESSIONAL_SERVICES", "OFFICE_SUPPLY"),
    (48, "MICROSOFT", r"microsoft|xbox|office\s?365|azure", "DIGITAL_SERVICES", "SAAS_BIG_TECH", "MICROSOFT_ECOSYSTEM"),
    (49, "META", r"meta\s?platforms|facebook\s?(ads|pay)", "DIGITAL_SERVICES", "SAAS_BIG_TECH", "META_ECOSYSTEM"),
    (50, "STEAM", "steam|steampowered|valve", "DIGITAL_SERVICES", "GAMING", "GAMING_PLATFORM"),
    (51, "LINE_STICKER", r"line\s?(sticker|store|game|webtoon)", "DIGITAL_SERVICES", "GAMING", "GAMING_PLATFORM"),
    (55, "BIGC", r"big\s?c(?!inema)", "EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "RETAIL_GROCERY_MODERN"),
    (56, "LOTUS", r"lotus|tesco\s?lotus", "EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "RETAIL_GROCERY_MODERN"),
    (57, "TOPS", r"tops\s?(market|daily|super)?", "EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "RETAIL_GROCERY_MODERN"),
    (58, "GOURMET_MKT", r"gourmet\s?market|villa\s?market", "EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "PREMIUM_GROCERY"),
    (59, "FOODLAND", "foodland", "EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "RETAIL_GROCERY_MODERN"),
    (60, "MAXVALU", r"maxvalu|max\s?value", "EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "RETAIL_GROCERY_MODERN"),
    (65, "SEVEN11", r"7[\s\-/]?eleven|7/11|seven.eleven", "EVERYDAY_ESSENTIALS", "CONVENIENCE_STORE", "CONVENIENCE_CHAIN"),
    (66, "FAMILYMART", r"familymart|family\s?mart", "EVERYDAY_ESSENTIALS", "CONVENIENCE_STORE", "CONVENIENCE_CHAIN"),
    (67, "LAWSON", r"lawson|108\s?(shop|mart)?", "EVERYDAY_ESSENTIALS", "CONVENIENCE_STORE", "CONVENIENCE_CHAIN"),
    (68, "CJ_EXPRESS", r"cj\s?(express|more|supermarket)", "EVERYDAY_ESSENTIALS", "CONVENIENCE_STORE", "CONVENIENCE_CHAIN"),
    (69, "MINI_BIGC", r"mini\s?big\s?c", "EVERYDAY_ESSENTIALS", "CONVENIENCE_STORE", "CONVENIENCE_CHAIN"),
    (70, "MAKRO", r"makro|siam\s?makro", "EVERYDAY_ESSENTIALS", "WHOLESALE", "WHOLESALE_CLUB"),
    (75, "PTT", r"\bptt\b|ptt\s?(station|oil|public)", "EVERYDAY_ESSENTIALS", "FUEL", "FUEL_STATION"),
    (76, "SHELL", r"\bshell\b", "EVERYDAY_ESSENTIALS", "FUEL", "FUEL_STATION"),
    (77, "BANGCHAK", "bangchak", "EVERYDAY_ESSENTIALS", "FUEL", "FUEL_STATION"),
    (78, "CALTEX", "caltex|chevron", "EVERYDAY_ESSENTIALS", "FUEL", "FUEL_STATION"),
    (79, "ESSO", r"\besso\b|exxon", "EVERYDAY_ESSENTIALS", "FUEL", "FUEL_STATION"),
    (80, "SUSCO", "susco", "EVERYDAY_ESSENTIALS", "FUEL", "FUEL_STATION"),
    (82, "BOOTS", r"\bboots\b", "EVERYDAY_ESSENTIALS", "PHARMACY_DRUGSTORE", "PHARMACY_CHAIN"),
    (83, "WATSONS", "watsons|watson", "HEALTH_WELLNESS", "BEAUTY_WELLNESS", "BEAUTY_RETAIL"),
    (84, "FASCINO", "fascino", "HEALTH_WELLNESS", "BEAUTY_WELLNESS", "BEAUTY_RETAIL"),
    (85, "BUMRUNGRAD", "bumrungrad", "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "HOSPITAL_PRIVATE"),
    (86, "BKKHOSP", r"bangkok\s?hospital|bdms|bangkok\s?dusit", "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "HOSPITAL_PRIVATE"),
    (87, "SAMITIVEJ", "samitivej", "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "HOSPITAL_PRIVATE"),
    (88, "BNH", r"\bbnh\b", "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "HOSPITAL_PRIVATE"),
    (89, "BEAUTY_SPA", r"spa\b|massage|onsen|let.s relax", "HEALTH_WELLNESS", "BEAUTY_WELLNESS", "SPA_WELLNESS"),
    (90, "CENTRAL_MALL", r"central\s?(world|embassy|chidlom|plaza|ladprao|pinklao|rama|westgate|festival|village)", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "CENTRAL_GROUP_MALLS"),
    (91, "CENTRAL_DEPT", r"central\s?department|central\s?online", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "CENTRAL_GROUP_MALLS"),
    (92, "EMPORIUM", r"emporium|emquartier|em\s?quarter|em\s?sphere", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "THE_MALL_GROUP"),
    (93, "PARAGON", r"siam\s?paragon|paragon", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "SIAM_EM_DISTRICT"),
    (94, "SIAM_CENTER", r"siam\s?(center|discovery|square)", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "SIAM_EM_DISTRICT"),
    (95, "ICONSIAM", r"iconsiam|icon\s?siam", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "ICONSIAM"),
    (96, "MEGA", r"mega\s?(bangna|cineplex|bang)", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "MEGA_MALLS"),
    (97, "TERMINAL21", r"terminal\s?21", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "DEPARTMENT_STORES"),
    (98, "ROBINSON", "robinson", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "DEPARTMENT_STORES"),
    (99, "THE_MALL", r"the\s?mall(?!\s?group)", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "THE_MALL_GROUP"),
    (100, "PLATINUM_MALL", r"platinum\s?(fashion|mall)", "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "DEPARTMENT_STORES"),
    (102, "UNIQLO", "uniqlo", "SHOPPING_RETAIL", "FASHION", "COMMON_FASHION_BRANDS"),
    (103, "HM", r"h&m|h\s?and\s?m", "SHOPPING_RETAIL", "FASHION", "COMMON_FASHION_BRANDS"),
    (104, "ZARA", r"\bzara\b", "SHOPPING_RETAIL", "FASHION", "COMMON_FASHION_BRANDS"),
    (105, "NIKE", r"\bnike\b", "SHOPPING_RETAIL", "FASHION", "SPORTSWEAR"),
    (106, "ADIDAS", "adidas", "SHOPPING_RETAIL", "FASHION", "SPORTSWEAR"),
    (107, "UNDER_ARMOUR", r"under\s?armour", "SHOPPING_RETAIL", "FASHION", "SPORTSWEAR"),
    (108, "LV", r"louis\s?vuitton|\blv\b", "SHOPPING_RETAIL", "FASHION", "LUXURY_FASHION_BRANDS"),
    (109, "GUCCI", "gucci", "SHOPPING_RETAIL", "FASHION", "LUXURY_FASHION_BRANDS"),
    (110, "PRADA", "prada", "SHOPPING_RETAIL", "FASHION", "LUXURY_FASHION_BRANDS"),
    (111, "CHANEL", "chanel", "SHOPPING_RETAIL", "FASHION", "LUXURY_FASHION_BRANDS"),
    (112, "HERMES", "hermes|herm.s", "SHOPPING_RETAIL", "FASHION", "LUXURY_FASHION_BRANDS"),
    (113, "DIOR", r"\bdior\b", "SHOPPING_RETAIL", "FASHION", "LUXURY_FASHION_BRANDS"),
    (114, "BURBERRY", "burberry", "SHOPPING_RETAIL", "FASHION", "LUXURY_FASHION_BRANDS"),
    (116, "POWERBUY", r"power\s?buy", "SHOPPING_RETAIL", "ELECTRONICS", "ELECTRONICS_RETAIL"),
    (117, "IT_CITY", r"it\s?city|banana\s?it|jib\b", "SHOPPING_RETAIL", "ELECTRONICS", "ELECTRONICS_RETAIL"),
    (118, "STUDIO7", r"studio\s?7|istudio|i\s?studio", "SHOPPING_RETAIL", "ELECTRONICS", "ELECTRONICS_RETAIL"),
    (120, "B2S", r"\bb2s\b", "SHOPPING_RETAIL", "BOOKS_STATIONERY", "BOOKSTORE_CHAIN"),
    (121, "SEED", r"\bse-?ed\b|se\s?education", "SHOPPING_RETAIL", "BOOKS_STATIONERY", "BOOKSTORE_CHAIN"),
    (122, "KINOKUNIYA", "kinokuniya", "SHOPPING_RETAIL", "BOOKS_STATIONERY", "BOOKSTORE_CHAIN"),
    (123, "ASIA_BOOKS", r"asia\s?books|naiin", "SHOPPING_RETAIL", "BOOKS_STATIONERY", "BOOKSTORE_CHAIN"),
    (124, "LEGO", r"\blego\b", "SHOPPING_RETAIL", "GIFTS_HOBBY_TOYS", "TOY_HOBBY"),
    (125, "MRDIY", r"mr\.?\s?d\.?i\.?y", "SHOPPING_RETAIL", "VARIETY_HOME", "VARIETY_STORE"),
    (126, "DAISO", "daiso", "SHOPPING_RETAIL", "VARIETY_HOME", "VARIETY_STORE"),
    (130, "MK_REST", r"\bmk\b.*restaurant|mk\s?suki", "FOOD_DINING", "RESTAURANTS", "THAI_CHAIN_RESTAURANTS"),
    (131, "SHABUSHI", r"shabushi|oishi|oishi\s?ramen", "FOOD_DINING", "RESTAURANTS", "THAI_CHAIN_RESTAURANTS"),
    (132, "SIZZLER", "sizzler", "FOOD_DINING", "RESTAURANTS", "INTERNATIONAL_CHAIN"),
    (133, "BBQ_PLAZA", r"bar-?b-?q\s?plaza|bbq\s?plaza", "FOOD_DINING", "RESTAURANTS", "THAI_CHAIN_RESTAURANTS"),
    (134, "FUJI", r"\bfuji\b", "FOOD_DINING", "RESTAURANTS", "THAI_CHAIN_RESTAURANTS"),
    (135, "YAYOI", "yayoi", "FOOD_DINING", "RESTAURANTS", "THAI_CHAIN_RESTAURANTS"),
    (136, "HAIDILAO", r"haidilao|hai\s?di\s?lao", "FOOD_DINING", "RESTAURANTS", "INTERNATIONAL_CHAIN"),
    (137, "SP", r"\bs&p\b|s\s?and\s?p\s?rest", "FOOD_DINING", "RESTAURANTS", "THAI_CHAIN_RESTAURANTS"),
    (140, "MCDONALDS", r"mcdonald|mc\s?donald", "FOOD_DINING", "FAST_FOOD_QSR", "FAST_FOOD_CHAIN"),
    (141, "KFC", r"\bkfc\b|kentucky", "FOOD_DINING", "FAST_FOOD_QSR", "FAST_FOOD_CHAIN"),
    (142, "BURGER_KING", r"burger\s?king", "FOOD_DINING", "FAST_FOOD_QSR", "FAST_FOOD_CHAIN"),
    (143, "PIZZA", r"pizza\s?(company|hut)|domino", "FOOD_DINING", "FAST_FOOD_QSR", "FAST_FOOD_CHAIN"),
    (144, "SUBWAY", "subway", "FOOD_DINING", "FAST_FOOD_QSR", "FAST_FOOD_CHAIN"),
    (145, "BONCHON", r"bonchon|bon\s?chon", "FOOD_DINING", "FAST_FOOD_QSR", "FAST_FOOD_CHAIN"),
    (146, "STARBUCKS", "starbucks", "FOOD_DINING", "COFFEE_CAFE", "COFFEE_CHAINS"),
    (147, "CAFE_AMAZON", r"caf.\s?amazon|cafe\s?amazon", "FOOD_DINING", "COFFEE_CAFE", "COFFEE_CHAINS"),
    (148, "INTHANIN", r"inthanin|true\s?coffee", "FOOD_DINING", "COFFEE_CAFE", "COFFEE_CHAINS"),
    (149, "DUNKIN", r"dunkin|krispy\s?kreme", "FOOD_DINING", "BAKERY_DESSERT", "BAKERY_CHAIN"),
    (150, "SWENSENS", r"swensen|after\s?you|dairy\s?queen", "FOOD_DINING", "BAKERY_DESSERT", "BAKERY_CHAIN"),
    (155, "THAI_AIRWAYS", r"thai\s?airway|thai\s?air(?!asia)", "TRAVEL_MOBILITY", "AIRLINES", "DOMESTIC_AIRLINE"),
    (156, "BANGKOK_AIR", r"bangkok\s?airway", "TRAVEL_MOBILITY", "AIRLINES", "DOMESTIC_AIRLINE"),
    (157, "AIRASIA", r"airasia|air\s?asia", "TRAVEL_MOBILITY", "AIRLINES", "DOMESTIC_AIRLINE"),
    (158, "NOKAIR", r"nok\s?air", "TRAVEL_MOBILITY", "AIRLINES", "DOMESTIC_AIRLINE"),
    (159, "VIETJET", r"vietjet|viet\s?jet", "TRAVEL_MOBILITY", "AIRLINES", "DOMESTIC_AIRLINE"),
    (160, "LION_AIR", r"lion\s?air", "TRAVEL_MOBILITY", "AIRLINES", "DOMESTIC_AIRLINE"),
    (161, "SQ", r"singapore\s?airlines|\bsia\b", "TRAVEL_MOBILITY", "AIRLINES", "INTERNATIONAL_AIRLINE"),
    (162, "EMIRATES", "emirates", "TRAVEL_MOBILITY", "AIRLINES", "INTERNATIONAL_AIRLINE"),
    (163, "QATAR", r"qatar\s?airway", "TRAVEL_MOBILITY", "AIRLINES", "INTERNATIONAL_AIRLINE"),
    (164, "CATHAY", r"cathay\s?pacific", "TRAVEL_MOBILITY", "AIRLINES", "INTERNATIONAL_AIRLINE"),
    (166, "MARRIOTT", r"marriott|ritz.carlton|w\s?hotel|westin|st\.?\s?regis", "TRAVEL_MOBILITY", "HOTELS", "HOTEL_CHAIN"),
    (167, "HILTON", "hilton|conrad|waldorf", "TRAVEL_MOBILITY", "HOTELS", "HOTEL_CHAIN"),
    (168, "IHG", r"\bihg\b|intercontinental|holiday\s?inn|crowne\s?plaza", "TRAVEL_MOBILITY", "HOTELS", "HOTEL_CHAIN"),
    (169, "ACCOR", "accor|novotel|ibis|pullman|sofitel|movenpick", "TRAVEL_MOBILITY", "HOTELS", "HOTEL_CHAIN"),
    (170, "HYATT", "hyatt", "TRAVEL_MOBILITY", "HOTELS", "HOTEL_CHAIN"),
    (171, "CENTARA", r"centara|dusit\s?thani|anantara", "TRAVEL_MOBILITY", "HOTELS", "BOUTIQUE_HOTEL"),
    (172, "SHERATON", r"sheraton|le\s?meridien|four\s?points", "TRAVEL_MOBILITY", "HOTELS", "HOTEL_CHAIN"),
    (175, "AGODA", "agoda", "TRAVEL_MOBILITY", "OTA_TRAVEL", "OTA_PLATFORM"),
    (176, "BOOKING_COM", r"booking\.com|booking\s?com", "TRAVEL_MOBILITY", "OTA_TRAVEL", "OTA_PLATFORM"),
    (177, "TRAVELOKA", "traveloka", "TRAVEL_MOBILITY", "OTA_TRAVEL", "OTA_PLATFORM"),
    (178, "EXPEDIA", r"expedia|hotels\.com", "TRAVEL_MOBILITY", "OTA_TRAVEL", "OTA_PLATFORM"),
    (179, "KLOOK", "klook|getyourguide|kkday", "TRAVEL_MOBILITY", "OTA_TRAVEL", "ACTIVITY_BOOKING"),
    (180, "HOMEPRO", r"homepro|home\s?pro", "HOME_LIVING", "HOME_IMPROVEMENT", "HOME_IMPROVEMENT_STORE"),
    (181, "GLOBAL_HSE", r"global\s?house", "HOME_LIVING", "HOME_IMPROVEMENT", "HOME_IMPROVEMENT_STORE"),
    (182, "THAIWATSADU", r"thai\s?watsadu|baan\s?&\s?beyond", "HOME_LIVING", "HOME_IMPROVEMENT", "HOME_IMPROVEMENT_STORE"),
    (183, "DOHOME", r"dohome|do\s?home", "HOME_LIVING", "HOME_IMPROVEMENT", "HOME_IMPROVEMENT_STORE"),
    (184, "IKEA", "ikea", "HOME_LIVING", "FURNITURE_HOME", "FURNITURE_STORE"),
    (185, "SB_FURNITURE", r"sb\s?furniture|sb\s?design|index\s?living|modernform", "HOME_LIVING", "FURNITURE_HOME", "FURNITURE_STORE"),
    (188, "AIS", r"\bais\b|advance\s?info", "DIGITAL_SERVICES", "TELCO_MOBILE", "TELCO_MOBILE_PROVIDER"),
    (189, "DTAC", r"\bdtac\b", "DIGITAL_SERVICES", "TELCO_MOBILE", "TELCO_MOBILE_PROVIDER"),
    (190, "TRUEMOVE", r"true\s?(move|corp|online|vision|id)", "DIGITAL_SERVICES", "TELCO_MOBILE", "TELCO_MOBILE_PROVIDER"),
    (191, "THREE_BB", r"3bb|3\s?bb|triple\s?t", "DIGITAL_SERVICES", "TELCO_BROADBAND", "TELCO_BROADBAND_PROVIDER"),
    (192, "TOT", r"\btot\b|tot\s?public", "DIGITAL_SERVICES", "TELCO_BROADBAND", "TELCO_BROADBAND_PROVIDER"),
    (195, "AIA", r"\baia\b", "FINANCIAL_SERVICES", "INSURANCE", "INSURANCE_PAYMENTS"),
    (196, "MUANGTHAI", r"muang\s?thai\s?(life|insurance)", "FINANCIAL_SERVICES", "INSURANCE", "INSURANCE_PAYMENTS"),
    (197, "FWD", r"\bfwd\b|fwd\s?insurance", "FINANCIAL_SERVICES", "INSURANCE", "INSURANCE_PAYMENTS"),
    (198, "BITKUB", "bitkub", "FINANCIAL_SERVICES", "INVESTMENT_TRADING", "TRADING_PLATFORM"),
    (200, "GOVERNMENT", r"government|counter\s?service|revenue\s?dept", "B2B_PROFESSIONAL", "GOVERNMENT", "GOVERNMENT_SERVICE"),
    (201, "OFFICEMATE", r"officemate|office\s?mate|b2s\s?office", "B2B_PROFESSIONAL", "PROFESSIONAL_SERVICES", "OFFICE_SUPPLY"),
    (202, "KERRY", r"kerry\s?express|flash\s?express|j&t|best\s?express", "B2B_PROFESSIONAL", "PROFESSIONAL_SERVICES", "COURIER_LOGISTICS"),
    (210, "MAJOR_CINEMA", r"major\s?(cineplex|cinema)|sf\s?cinema", "ENTERTAINMENT_LEISURE", "CINEMA", "CINEMA_CHAIN"),
    (211, "DECATHLON", r"decathlon|super\s?sport", "ENTERTAINMENT_LEISURE", "SPORTS_ACTIVITY", "SPECIALITY_SPORT"),
    (212, "GOLF", r"golf\s?(club|course|range|driving)", "ENTERTAINMENT_LEISURE", "SPORTS_ACTIVITY", "GOLF"),
    (213, "FITNESS", r"fitness\s?first|virgin\s?active|jetts|anytime\s?fitness", "HEALTH_WELLNESS", "FITNESS_GYM", "GYM_FITNESS"),
    (220, "EDUCATION", r"university|\buniv\b|school|college|academy", "EDUCATION", "SCHOOL_UNIVERSITY", "UNIVERSITY"),
    (221, "TUTORING", r"tutor|kumon|british\s?council|wall\s?street\s?english", "EDUCATION", "TUTORING_LANGUAGE", "TUTORING_CENTER"),
    (225, "CAR_SERVICE", r"auto\s?service|car\s?care|b-?quik|cockpit|tyreplus", "AUTOMOTIVE", "VEHICLE_SERVICE", "CAR_SERVICE"),
    (226, "CAR_RENTAL", r"hertz|avis|budget\s?rent|thai\s?rent", "AUTOMOTIVE", "CAR_RENTAL", "CAR_RENTAL_AGENCY"),
    (230, "PHARMACY", r"pharmacy|drugstore|pharma\s?choice|fascino\s?pharma", "EVERYDAY_ESSENTIALS", "PHARMACY_DRUGSTORE", "PHARMACY_CHAIN"),
    (235, "ELECTRIC", r"provincial\s?electric|metropolitan\s?electric|pea\b|mea\b", "EVERYDAY_ESSENTIALS", "UTILITIES", "WATER_ELECTRIC_GAS"),
    (236, "WATER", r"waterworks|water\s?supply|mwa\b|pwa\b", "EVERYDAY_ESSENTIALS", "UTILITIES", "WATER_ELECTRIC_GAS"),
    (240, "HOSPITAL_GEN", r"hospital|\bhosp\b|medical\s?center", "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "HOSPITAL_GENERAL"),
    (241, "CLINIC_GEN", "clinic(?!.*beauty|.*cosmetic|.*skin|.*derma)", "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "CLINIC_GENERAL"),
    (242, "DIAGNOSTIC_LAB", r"\blab\b|laboratory|diagnostic|pathology|radiology|x-?ray|mri\b|ct\s?scan", "HEALTH_WELLNESS", "DIAGNOSTICS", "DIAGNOSTIC_LAB"),
    (243, "DENTAL", r"dental|dentist|orthodont|\btooth\b", "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "DENTAL_CLINIC"),
    (244, "OPTICAL", r"optical|optician|eye\s?care|\blens\b|spec\s?saver|top\s?charoen", "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "OPTICAL_CLINIC"),
    (245, "SALON", r"salon|hair\s?(cut|dresser|studio)|barber|\bcuts\b", "HEALTH_WELLNESS", "BEAUTY_WELLNESS", "BEAUTY_SALON"),
    (246, "COSMETIC_CLIN", r"cosmetic\s?clinic|skin\s?clinic|dermatolog|aesthetic|laser\s?clinic|botox", "HEALTH_WELLNESS", "BEAUTY_WELLNESS", "COSMETIC_CLINIC"),
    (247, "NAIL_BEAUTY", r"nail\s?(salon|spa|bar)|manicure|pedicure|wax(ing)?\b", "HEALTH_WELLNESS", "BEAUTY_WELLNESS", "BEAUTY_SALON"),
    (248, "GAS_UTILITY", r"ptt\s?gas|\bgas\s?(supply|authority)\b|\bngv\b", "EVERYDAY_ESSENTIALS", "UTILITIES", "WATER_ELECTRIC_GAS"),
    (249, "GOVT_PAYMENT", r"counter\s?service|pay\s?at\s?post|bill\s?payment|\bbill\s?pay\b", "B2B_PROFESSIONAL", "GOVERNMENT", "GOVERNMENT_SERVICE"),
    (250, "INTERNET_ISP", r"\bcat\s?telecom|nt\s?broadband|true\s?internet|\bjasmine\b", "DIGITAL_SERVICES", "TELCO_BROADBAND", "TELCO_BROADBAND_PROVIDER"),
    (251, "PET_VET", r"pet\s?(shop|store|hospital)|veterinar|vet\s?clinic|\bpet\b.*mart", "EVERYDAY_ESSENTIALS", "PET_ANIMAL", "PET_CARE"),
]

# --------------------------------------------------------------------------
# Campaign use case per persona
# --------------------------------------------------------------------------
CAMPAIGN_USE_CASES = {
    "TRAVEL_CENTRIC": "travel_benefits|fx_campaigns|premium_card|airline_hotel_partners",
    "DIGITAL_NATIVE": "digital_activation|bnpl|streaming_bundles|wallet_integration",
    "EVERYDAY_ANCHOR": "cashback|grocery_convenience_offers|line_protection|essentials",
    "LIFESTYLE_SOCIAL": "dining_offers|weekend_campaigns|merchant_partnerships|food_delivery",
    "AFFLUENT_LIFESTYLE": "premium_upgrade|luxury_merchant_offers|exclusive_events|travel_premium",
    "BUSINESS_PROXY": "sme_proxy_products|working_capital|separate_from_retail_analytics",
    "CONCENTRATED_LOYALIST": "merchant_specific_rewards|category_diversification|cross_sell",
    "EMERGING_MOBILE": "mobile_first_offers|wallet_bundles|digital_onboarding",
    "DIVERSIFIED_EXPLORER": "lifestyle_rewards|broad_merchant_network|premium_migration",
    "DORMANT_LOW_ACTIVITY": "reactivation|spend_stimulation|dormant_recovery",
}
CAMPAIGN_DEFAULT = "general_engagement"

# --------------------------------------------------------------------------
# Broad rule set (second, coarser classification)
# --------------------------------------------------------------------------
BROAD_TOPUP = r"(top\s?up|wallet\s?top\s?up|stored\s?value|poi funding|money transfer|money orders)"
BROAD_WALLET = r"(truemoney|true\s?money|rabbit\s?line\s?pay|line\s?pay|linepay|shopee\s?pay|shopeepay|blueplus|grabpay)"
BROAD_PROCESSOR = r"(paypal|2c2p|omise|xendit|gbprimepay|paysolutions|siampay|lianlian|payw\*|kbank\*meta pay|meta pay)"
BROAD_MARKETPLACE = r"(shopee|lazada|amazon|ebay|aliexpress)"
BROAD_FOOD_DELIVERY = r"(grabfood|foodpanda|lineman|line\s?man|robinhood)"
BROAD_RIDE_HAILING = r"(grab|bolt)"
BROAD_LUXURY_MALL = r"(paragon|iconsiam|emporium|emquartier|central embassy|gaysorn|central chidlom|one bangkok)"
BROAD_CENTRAL = r"(central|central plaza|central festival|central pattana|central westgate|central ladprao|central rama)"
BROAD_THE_MALL = r"(the mall|ngamwongwan|bangkapi|thapra|bangkae)"
BROAD_SIAM_EM = r"(siam paragon|emporium|emquartier|emsphere|siam center|siam discovery)"
BROAD_MEGA = r"(mega bangna|fashion island|terminal 21|future park|seacon|westgate)"
BROAD_B2B = r"(office|logistics|courier|professional services|consulting|legal|accounting|warehouse|industrial supplies|wholesale)"

# Broad rules; a shared priority is settled by the order below
# (priority, L1, L2, L3, regex_pattern)
BROAD_RULES = [
    (10, "DIGITAL_SERVICES", "BIG_TECH", "GOOGLE_ECOSYSTEM", r"\b(google(\*| )?(play|services|ads)?|youtube)\b"),
    (10, "DIGITAL_SERVICES", "BIG_TECH", "META_ECOSYSTEM", r"\b(meta(\*| )?pay|facebook|instagram(\*| )?ads?)\b"),
    (10, "DIGITAL_SERVICES", "BIG_TECH", "MICROSOFT_ECOSYSTEM", r"\b(microsoft(\s?store)?|xbox)\b"),
    (10, "DIGITAL_SERVICES", "STREAMING", "STREAMING_CONTENT", r"\b(netflix|spotify|disney|youtube premium|apple music)\b"),
    (10, "DIGITAL_SERVICES", "GAMING", "GAMING_PLATFORMS", r"\b(steam|roblox|garena|mlbb|playstation)\b"),
    (15, "FINANCIAL_SERVICES", "DIGITAL_WALLET", "DIGITAL_WALLET_TOPUP", BROAD_WALLET),
    (15, "FINANCIAL_SERVICES", "PAYMENT_INFRA", "PAYMENT_PROCESSORS", BROAD_PROCESSOR),
    (20, "SHOPPING_RETAIL", "MARKETPLACE_ECOM", "ECOM_MARKETPLACE_TH", BROAD_MARKETPLACE),
    (25, "FOOD_DINING", "FOOD_DELIVERY", "FOOD_DELIVERY_APP", BROAD_FOOD_DELIVERY),
    (25, "TRAVEL_MOBILITY", "RIDE_HAILING", "RIDE_HAILING", BROAD_RIDE_HAILING),
    (30, "FOOD_DINING", "COFFEE_CAFE", "COFFEE_CHAINS", "(starbucks|cafe amazon|true coffee|punthai|coffee|cafe)"),
    (30, "FOOD_DINING", "FAST_FOOD_QSR", "RESTAURANT_QSR", "(mcdonald|kfc|burger king|subway|chester|swensen|pizza|sizzler|mk restaurant|yayoi)"),
    (40, "EVERYDAY_ESSENTIALS", "GROCERY_MODERN", "RETAIL_GROCERY_MODERN", "(big c|lotus|tesco|makro|tops|gourmet market|foodland|villa market|maxvalu|maxvalue)"),
    (40, "EVERYDAY_ESSENTIALS", "CONVENIENCE_STORE", "CONVENIENCE_STORE", r"(7\s?-?eleven|7/11|familymart|family mart|mini big c)"),
    (40, "EVERYDAY_ESSENTIALS", "PHARMACY_DRUGSTORE", "PHARMACY_CHAIN", "(boots|watsons|fascino|save drug|drug stores|pharmacy)"),
    (40, "AUTOMOTIVE", "FUEL", "FUEL_STATION", "(ptt|bangchak|shell|esso|caltex|susco|fuel|service station)"),
    (40, "EVERYDAY_ESSENTIALS", "TELCO_MOBILE", "TELCO_MOBILE", "(ais|truemove|true move|dtac|3bb|nt broadband|telecom|telephone|broadband)"),
    (50, "TRAVEL_MOBILITY", "HOTELS", "HOTEL", "(hotel|resort|marriott|hilton|hyatt|sheraton|ibis|novotel|holiday inn|movenpick|four seasons)"),
    (50, "TRAVEL_MOBILITY", "AIRLINES", "AIRLINES", "(airways|airlines|airline|emirates|thai airways|lufthansa|qatar airways|singapore airlines|airasia|jetstar)"),
    (50, "TRAVEL_MOBILITY", "OTA_TRAVEL", "OTA_TRAVEL", r"(agoda|booking\.com|expedia|trip\.com|traveloka)"),
    (60, "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "SIAM_EM_DISTRICT", BROAD_SIAM_EM),
    (60, "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "CENTRAL_GROUP_MALLS", BROAD_CENTRAL),
    (60, "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "THE_MALL_GROUP", BROAD_THE_MALL),
    (60, "SHOPPING_RETAIL", "MALLS_DEPARTMENT", "MEGA_MALLS", BROAD_MEGA),
    (65, "SHOPPING_RETAIL", "PREMIUM_RETAIL", "LUXURY_FASHION_BRANDS", BROAD_LUXURY_MALL),
    (70, "SHOPPING_RETAIL", "BOOKS_STATIONERY", "BOOKS_STATIONERY", "(naiin|asia books|b2s|se-ed|book|stationery|office supplies)"),
    (70, "ENTERTAINMENT_LEISURE", "SPORTS_ACTIVITY", "SPECIALITY_SPORT", "(supersports|sport|soccer pro|warhammer|fitness|golf|bowling|pool)"),
    (80, "HEALTH_WELLNESS", "HOSPITAL_CLINIC", "HOSPITAL_MEDICAL", "(hospital|clinic|medical|dental|bumrungrad|bangkok hospital|samitivej)"),
    (80, "HOME_LIVING", "HOME_IMPROVEMENT", "HOMEMATERIAL_FURNITURE", "(homepro|thaiwatsadu|global house|ikea|index living|furniture|hardware|building materials)"),
    (85, "FINANCIAL_SERVICES", "INSURANCE", "INSURANCE_PAYMENTS", "(insurance|premiums|underwriting)"),
    (85, "FINANCIAL_SERVICES", "INVESTMENT_TRADING", "TRADING_PLATFORMS", "(securities|broker|brokerage|trading|investment|etoro|plus500|binance|coinbase|okx)"),
    (90, "B2B_PROFESSIONAL", "PROFESSIONAL_SERVICES", "B2B_PROFESSIONAL", BROAD_B2B),
]
SOURCE_SENTINELS = ["#N/A", "null", ""]

# Columns every broad enriched table carries (NULL string when absent)
BROAD_OUTPUT_COLUMNS = [
    "CUST_NUM", "txn_date", "txn_month", "txn_amount", "merchant_key", "mcht_nm_norm",
    "match_text", "tax_l1", "tax_l2", "tax_l3", "channel_tag", "geo_tag", "in_app_tag",
    "wallet_flag", "topup_flag", "processor_flag", "taxonomy_source_used",
    "taxonomy_confidence_tag",
]

# --------------------------------------------------------------------------
# Single-pattern wallet list of the small variant
# --------------------------------------------------------------------------
SIMPLE_WALLET = "truemoney|linepay|rabbit line pay|shopeepay"
SIMPLE_SIZE_TIERS = [("MICRO", 100), ("SMALL", 500), ("STANDARD", 2000), ("MID", 10000)]
SIMPLE_SIZE_TIER_TOP = "LARGE"

# --------------------------------------------------------------------------
# Weights and cut-offs of scores, personas, overlays, regimes and risks.
# A score is the sum of columns times weights and of the points whose condition holds,
# at most 1. In lists of (label, condition) the first that holds gives the label.
# --------------------------------------------------------------------------
SCORE_WEIGHTS = {
    "score_travel": [("l1_travel_mobility_share_m", 2.0), ("xborder_share_3m", 1.5)],
    "score_affluent": [("premium_share_3m", 3.0)],
    "score_digital": [("online_share_3m", 1.2), ("l1_digital_services_share_m", 1.5)],
    "score_food_social": [("l1_food_dining_share_m", 1.5), ("food_delivery_share_m", 2.0)],
    "score_everyday": [("grocery_share_3m", 2.0), ("l1_everyday_essentials_share_m", 1.5)],
    "score_mobile_wallet": [("wallet_share_3m", 2.0), ("online_share_3m", 0.8)],
    "score_concentration": [("top1_merchant_share_m", 1.5), ("merchant_hhi_m", 1.2)],
    "score_business_proxy": [("business_proxy_share_m", 3.0)],
}
SCORE_POINTS = {
    "score_travel": [("travel_booking_txn_cnt_m >= 2", 0.3)],
    "score_affluent": [("avg_ticket_3m > 5000", 0.3), ("avg_ticket_3m > 10000", 0.2)],
}
SCORE_MOST = {"score_business_proxy": 0.5}
SCORE_SURE = {"score_business_proxy": "business_proxy_flag = 'LIKELY_BUSINESS'"}

PERSONAS = [
    ("DORMANT_LOW_ACTIVITY", "spend_regime = 'DORMANT' OR feature_quality_flag = 'ZERO_SPEND'"),
    ("BUSINESS_PROXY", "business_proxy_flag = 'LIKELY_BUSINESS'"),
    ("TRAVEL_CENTRIC", "l1_travel_mobility_share_m > 0.20 OR xborder_share_3m > 0.15 OR travel_booking_txn_cnt_m >= 2"),
    ("AFFLUENT_LIFESTYLE", "premium_share_3m > 0.10 AND avg_ticket_3m > 5000"),
    ("DIGITAL_NATIVE", "online_share_3m > 0.55 OR l1_digital_services_share_m > 0.25"),
    ("LIFESTYLE_SOCIAL", "l1_food_dining_share_m > 0.25 OR coalesce(l2_restaurants_share_m, 0)"
                         " + coalesce(l2_food_delivery_share_m, 0) + coalesce(l2_coffee_cafe_share_m, 0) > 0.25"),
    ("CONCENTRATED_LOYALIST", "top1_merchant_share_m > 0.50 OR merchant_hhi_m > 0.35"),
    ("EMERGING_MOBILE", "wallet_share_3m > 0.20 AND online_share_3m > 0.30"),
    ("DIVERSIFIED_EXPLORER", "category_breadth_m >= 5 AND merchant_entropy_3m > 2.5"),
]
PERSONA_REST = "EVERYDAY_ANCHOR"

OVERLAYS = {
    "subscription_heavy": "subscription_merchant_cnt_m >= 2",
    "wallet_dependent": "wallet_share_3m > 0.25",
    "food_delivery_native": "food_delivery_txn_cnt_m >= 3 OR l2_food_delivery_share_m > 0.10",
    "cross_border_frequent": "xborder_share_3m > 0.10",
    "weekend_spender": "weekend_share_m > 0.45",
    "healthcare_engaged": "coalesce(l2_hospital_clinic_share_m, 0) + coalesce(l2_beauty_wellness_share_m, 0) > 0.10",
    "premium_retail_oriented": "premium_share_3m > 0.08",
    "convenience_dependent": "convenience_dependence = 'HIGH'",
    "installment_buyer_proxy": "avg_ticket_m > 5000 AND txn_cnt_m <= 5 AND max_ticket_m > 10000",
    "fuel_dependent": "fuel_dependence = 'HIGH'",
    "reactivating_user": "spend_regime = 'REACTIVATING'",
    "business_spend_proxy": "business_proxy_flag IN ('LIKELY_BUSINESS', 'POSSIBLE_BUSINESS')",
    "risk_monitor_flag": "concentration_shock_flag = 1 OR spend_drop_flag = 1 OR topup_overdependence_flag = 1"
                         " OR high_freq_low_ticket_flag = 1 OR unstable_flag = 1",
    "grocery_anchor": "grocery_share_m >= 0.30",
    "payday_spender": "payday_share_m >= 0.50",
    "ride_hailing_regular": "ride_hailing_share_m >= 0.10",
}

# label column -> (label, condition) in order, and the label of the rest
WALLET_LABELS = {
    "wallet_dependence_flag": (
        [("HIGH_WALLET", "wallet_share_m > 0.50"), ("MODERATE_WALLET", "wallet_share_m > 0.20")], "LOW_WALLET"),
}
WALLET_FLAGS = {
    "topup_heavy_flag": "topup_share_m > 0.30",
    "processor_mediated_flag": "spend_amt_m > 0 AND processor_spend_m / spend_amt_m > 0.20",
}
REGIME_LABELS = {
    "spend_regime": ([
        ("DORMANT", "txn_cnt_m = 0"), ("REACTIVATING", "coalesce(txn_cnt_prev_m, 0) = 0"), ("LOW_VOLUME", "txn_cnt_m < 3"),
    ], "ACTIVE"),
    "premium_retail_orientation": ([("HIGH", "premium_share_m > 0.15"), ("MODERATE", "premium_share_m > 0.05")], "LOW"),
    "avg_ticket_affluence_proxy": (
        [("HIGH_AFFLUENCE_PROXY", "avg_ticket_m > 10000"), ("MID_AFFLUENCE_PROXY", "avg_ticket_m > 3000")], "STANDARD"),
    "travel_premium_proxy": ([("TRAVEL_ORIENTED", "l1_travel_mobility_share_m > 0.15")], "NON_TRAVEL"),
    "convenience_dependence": (
        [("HIGH", "l2_convenience_store_share_m > 0.20"), ("MODERATE", "l2_convenience_store_share_m > 0.10")], "LOW"),
    "fuel_dependence": ([("HIGH", "l2_fuel_share_m > 0.15"), ("MODERATE", "l2_fuel_share_m > 0.05")], "LOW"),
    "business_proxy_flag": ([
        ("LIKELY_BUSINESS", "l1_b2b_professional_share_m > 0.20 OR business_proxy_txn_cnt_m > txn_cnt_m * 0.3D"),
        ("POSSIBLE_BUSINESS", "l1_b2b_professional_share_m > 0.10"),
    ], "RETAIL_CONSUMER"),
}
RISK_FLAGS = {
    "concentration_shock_flag": "merchant_hhi_change_m > 0.15 AND merchant_hhi_m > 0.5",
    "spend_drop_flag": "spend_pct_change_m < -0.50",
    "category_shock_flag": "l1_migration_flag = 1 AND abs(spend_pct_change_m) > 0.30",
    "high_freq_low_ticket_flag": "txn_cnt_m > 30 AND avg_ticket_m < 200",
    "topup_overdependence_flag": "topup_share_m > 0.40 AND topup_txn_cnt_m > 5",
    "unstable_flag": "spend_regime = 'REACTIVATING' OR spend_stability_6m > 1.5",
}
QUALITY_LABELS = {
    "feature_quality_flag": ([
        ("ZERO_SPEND", "txn_cnt_m = 0"), ("LOW_VOLUME", "txn_cnt_m < 3"), ("SINGLE_MERCHANT", "uniq_merchants_m <= 1"),
    ], "GOOD"),
}
CONFIDENCE_LABELS = {
    "persona_confidence": (
        [("HIGH", "feature_quality_flag = 'GOOD'"), ("MEDIUM", "feature_quality_flag = 'LOW_VOLUME'")], "LOW"),
}
CONFIDENCE_SCORES = {"HIGH": 1.0, "MEDIUM": 0.5, "LOW": 0.2}
USE_CASE_LABELS = {
    "clm_use_case": ([
        ("line_increase_candidate", "spend_velocity_m > 0 AND avg_ticket_m > 3000 AND persona_confidence = 'HIGH'"),
        ("stable_recurring_spend|line_confidence", "recurring_spend_share_m > 0.30 AND spend_regime = 'ACTIVE'"),
        ("premium_migration_candidate",
         "primary_persona IN ('AFFLUENT_LIFESTYLE', 'TRAVEL_CENTRIC') AND premium_share_3m > 0.10"),
        ("diversified_healthy_spend|affluent_migration",
         "primary_persona = 'DIVERSIFIED_EXPLORER' AND category_breadth_m >= 5"),
    ], "standard_review"),
    "pricing_use_case": ([
        ("cross_border_pricing_relevant", "xborder_share_3m > 0.15"),
        ("travel_card_pricing", "primary_persona = 'TRAVEL_CENTRIC'"),
        ("subscription_card_features", "ms_subscription_heavy = 1"),
        ("wallet_integration_pricing", "ms_wallet_dependent = 1"),
        ("premium_product_pricing", "ms_premium_retail_oriented = 1"),
    ], "standard_pricing"),
}
