"""Values that the results depend on. They are data, not logic."""

# Names of the days and of the day parts that are counted.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_PARTS = ["Morning", "Afternoon", "Evening"]

# First and last hour of each day part; every other hour is night.
DAY_PART_HOURS = {"Morning": (9, 12), "Afternoon": (13, 17), "Evening": (18, 21)}
NIGHT = "Night"

# Result codes of the second call source; 21 to 28 share one label.
CALL_RESULT_LABELS = {
    2: "BUSY",
    3: "NO_ANSWER",
    5: "ANSWER",
    6: "SKIPPED CALL",
    7: "PROMISSED",
}
CALL_RESULT_RANGES = {(21, 28): "INBOUND CALLS"}
ANSWERED = "ANSWER"

# The position in the list is the model code of the phone type (first is 1).
PHONE_TYPES = [
    "ALTERNATIVE_PHONE",
    "CONTACT_PHONE",
    "EMPLOYMENT_PHONE",
    "FAX",
    "HOME_PHONE",
    "MOBILE_PHONE",
    "PHONE",
    "PREV_PRIMARY_MOBILE",
    "PRIMARY_MOBILE",
    "PRIMARY_MOBILE_EJ",
    "SECONDARY_MOBILE",
    "SKIP_TRACE_HOME",
    "SKIP_TRACE_MOBILE",
    "WORKING_PHONE",
]

# The position in the list is the model code of the direction (first is 1).
DIRECTIONS = ["OUTBOUND", "INBOUND", "INTERNAL"]

# Bureau codes of marital status and education.
MARITAL_CODES = {
    "1": "SINGLE",
    "2": "MARRIED",
    "3": "DIVORCED",
    "5": "LIVING_WITH_PARTNER",
}
EDUCATION_CODES = {3: "BACHELORS"}
EDUCATION_RANGES = {(1, 2): "SECONDARY_SCHOOL"}
GENDER_CODES = {"1": "M", "0": "F"}

# Push types that count, credit states that count, product types that are split.
PUSH_TYPES = ["PUSH_VIEWED", "CALLBACK_PUSH"]
ACTIVE_CREDIT_STATES = [2, 8]
PRODUCT_COLUMNS = {"REV": "cnt_act_cards", "CAL": "cnt_act_cash", "COL": "cnt_act_pos"}

# Vehicle models left out, home time zones, named device makers.
TRAILER_PATTERNS = ["%П/%", "%ПРИЦЕП%"]
HOME_TIME_ZONES = ["Asia/Almaty", "Etc/GMT+6"]
NAMED_DEVICES = ["IPHONE", "SAMSUNG"]

# Bureau alert rules, counted or flagged.
RULE_COUNTS = {
    "21": "amt_fcb_searched_1y",
    "2": "cnt_ext_overdue_7d_in_1y",
    "8": "cnt_changes_in_ext_payment_1y",
    "4": "cnt_new_ext_contracts_1y",
}
RULE_FLAGS = {"16": "flag_phone_is_changed_1y"}

# Spellings of a region in the sources, by region code.
REGION_NAMES = {
    1: ["г.Нур-Султан", "НУР-СУЛТАН"],
    2: [
        "г.Алматы",
        "АЛМАТЫ",
        "Ауэзовский район",
        "Бостандыкский район",
        "Алмалинский район",
        "Наурызбайский район",
        "Турксибский район",
        "Медеуский район",
    ],
    3: ["г.Шымкент", "ШЫМКЕНТ"],
    4: ["Алматинская область", "АЛМАТИНСКАЯ", "Илийский район", "Талгарский район"],
    5: ["Акмолинская область", "АКМОЛИНСКАЯ"],
    6: ["Атырауская область", "АТЫРАУСКАЯ"],
    7: ["Актюбинская область", "АКТЮБИНСКАЯ"],
    8: ["Восточно-Казахстанская область"],
    9: ["Жамбылская область", "ЖАМБЫЛСКАЯ"],
    10: ["Западно-Казахстанская область"],
    11: ["Карагандинская область", "КАРАГАНДИНСКАЯ"],
    12: ["Костанайская область", "КОСТАНАЙСКАЯ"],
    13: ["Кызылординская область", "Кызылорда Г.А."],
    14: ["Мангистауская область", "МАНГИСТАУСКАЯ"],
    15: ["Павлодарская область", "ПАВЛОДАРСКАЯ"],
    16: ["Северо-Казахстанская область"],
    17: [
        "Туркестанская область",
        "Туркестан Г.А.",
        "ТУРКЕСТАНСКАЯ ОБЛ.",
        "Сарыагашский район",
        "Шардаринский район",
    ],
    18: ["область Абай", "Семей Г.А."],
    19: ["область Жетісу"],
    20: ["область Ұлытау"],
}

# Columns the daily model reads, in its own order (a weekday number is added last).
DAILY_MODEL_FEATURES = [
    "past_days_last_call",
    "cnt_success_sms_6m",
    "rate_connect_monday",
    "rate_connect_friday",
    "rate_connect_tuesday",
    "rate_connect_thursday",
    "cnt_in_calls_6m",
    "rate_connect_wednesday",
    "rate_connect_sunday",
    "rate_connect_saturday",
    "pif_phone_type_code",
]

# Name and type of the columns of a score row, in order.
SCORE_COLUMNS = {
    "PHONE_NUMBER": "string",
    "ID_CUID": "bigint",
    "DATE_": "string",
    "SCORE": "double",
    "SK_DATE_SCORE": "int",
    "SCORE_GROUP": "int",
    "SK_DTIME_SCORE": "string",
}
