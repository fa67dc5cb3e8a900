"""Fixed values that must equal the source scripts' literals for the same results."""

# --- fixed values: start types and attribution outcomes -------------------
AUTO_PLAY = "Auto-Play"
UP_NEXT = "Clicked-Up-Next"
DISMISS = "Dismiss"
MANUAL = "Manual-Selection"
PLAY_END = "Vdo_End"
UNATTRIBUTED = "Unattributed"

# --- fixed values: click signal formats ------------------------------------
# player-event areas whose brand prefix is stripped, tested in this order
DETAIL_AREAS = ("episodes", "upsell", "more-like-this", "extras")
# title between the first '||' and the last '|' of an auto-play / up-next detail
CUE_TITLE_PATTERN = r"[|][|](.*)[|]"
# title of a rail click: letters, digits, blanks, '-', '.', ':' between pipes
RAIL_TITLE_PATTERN = r"[|]([a-zA-Z0-9\s-.:]+)[|]click"

# --- fixed values: title cleaning ------------------------------------------
TITLE_STRIP_CHARS = ":,.&'!"      # removed by the feeder / series cleaning
PROMO_STRIP_CHARS = ".&_':"       # removed by the promo report cleaning

# --- fixed values: series names that are really stations or platforms -------
STATION_MAX_LENGTH = 4
STATION_SUFFIXES = ("%tv", "%)", "%-dt", "%premium")
STATION_NAMES = ("ktvh-dt", "ksnv-dt", "Kgwn.2")
STATION_CALL_SIGNS = (r"(W)[a-zA-Z0-9]+-[a-zA-Z0-9]", r"(K)[a-zA-Z0-9]+-[a-zA-Z0-9]")
# episode titles whose series counts are known to be wrong in the raw data
EXCLUDED_EPISODES = (
    "yellowstone", "quantum leap", "dateline nbc", "pft live", "americas got talent all stars",
)
NO_SERIES = "N/a"
NO_EPISODE = "n/a"
NO_CHANNEL = "N/A"
VIEW_ALL = "view-all"

# --- fixed values: time constants ------------------------------------------
EASTERN = "America/New_York"
PLAY_SHIFT_SECONDS = 40          # a play is placed 40 s before its record time
SHORT_VIEW_SECONDS = 30          # single-show views up to 30 s count as auto-play
PROMO_CLOCK_SHIFT_HOURS = 5      # promo event clock is shifted back 5 h
PROMO_LEAD_MINUTES = 5           # usage counts from 5 min before a promo event
TOP_K = 50
MINOR_FEEDER_SHARE = 0.005
