"""Fixed values of the data model.

Everything in this module is a fixed value: results are only right with these names,
lengths and formats.
"""

# Event types, and their names in the session log.
EVENT_TYPES = ("click", "cart", "order")
LOG_TYPES = {"clicks": "click", "carts": "cart", "orders": "order"}
UNKNOWN_TYPE = "unknown"

# Columns an event must have, and the columns that identify it.
CORE_COLUMNS = ("session_id", "aid", "ts", "event_type", "user_id")
EVENT_KEYS = ("session_id", "aid", "ts", "event_type")

# User profile columns on events, and where the user dimension calls one differently.
PROFILE_COLUMNS = ("gender", "age_group", "region", "membership", "platform")
PROFILE_SOURCES = {"platform": "preferred_device"}

# Display order of user attributes.
GENDERS = ("F", "M")
AGE_GROUPS = ("10대", "20대", "30대", "40대", "50대", "60대 이상")

# Fixed value: longest wait of a landing batch.
FLUSH_SECONDS = 60

# Names of the marts and of the tables they are loaded into.
MART_TABLES = {
    "funnel_daily": "mart_funnel_daily",
    "session": "mart_session",
    "cohort": "mart_cohort",
    "item_stats": "mart_item_stats",
}
STG_TABLE = "stg_events"

# Fixed value: display time zone; stored times are UTC.
DISPLAY_ZONE = "Asia/Seoul"
