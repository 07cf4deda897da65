"""Fixed values.

Every name, lookup entry, pattern and threshold here has to keep its exact value for results to
stay comparable with tables that already exist.  Labels, patterns, window lengths, thresholds and
table names are defaults of parameters of the functions that use them, up to ``refresh_gold`` and
``dashboard_page``; topics, event types and the message schemas are what the other side expects.
"""

from __future__ import annotations

# Topics, event types and the site whose events are kept.
EDIT_TOPIC = "wiki_edits"
PAGE_TOPIC = "wiki_page_events"
EDIT_TYPES = ("edit", "new")
PAGE_TYPES = ("categorize", "log")
SITE = "en.wikipedia.org"

# Key written for an event whose id is missing or null, and the text used for an absent comment.
NULL_KEY = "None"
ABSENT_COMMENT = ""

# Namespace number -> label; every other number, and null, is labelled OTHER_NAMESPACE.
NAMESPACE_LABELS = {
    0: "Article",
    1: "Talk",
    2: "User",
    3: "User_Talk",
    4: "Wikipedia",
    5: "Wikipedia_Talk",
    6: "File",
    7: "File_Talk",
    10: "Template",
    11: "Template_Talk",
    14: "Category",
    15: "Category_Talk",
}
OTHER_NAMESPACE = "Other"

# Whole words that mark a comment as a revert.
REVERT_PATTERN = r"(?i)\b(revert|rv|rvv|undid)\b"

# Tumbling windows: label -> length in seconds.
GRANULARITIES = {"1min": 60, "5min": 300}
DEFAULT_GRANULARITY = "5min"

# Rolling baseline: length, number of standard deviations, digits kept in the bot ratio.
BASELINE_SECONDS = 3600
SIGMA = 2.0
BOT_RATIO_DIGITS = 4

# Whole days recomputed by a refresh before the current one.
LOOKBACK_DAYS = 2

# Dashboard: lookback choices in hours, rounding of "now" in minutes, list lengths, bot marker.
MIN_HOURS, DEFAULT_HOURS, MAX_HOURS = 1, 6, 48
NOW_FLOOR_MINUTES = 5
TOP_EDITORS = 20
LATEST_WINDOWS = 20
PREVIEW_EDITORS = 10
BOT_MARKER = " 🤖"

# Table names used when the caller names none.
BRONZE_EDITS_TABLE = "bronze_wiki_edits"
BRONZE_PAGE_TABLE = "bronze_wiki_page_events"
SILVER_TABLE = "silver_wiki_edits"
VOLUME_TABLE = "gold_edit_volume"
USER_TABLE = "gold_user_activity"
