"""Fixed values of the tick pipeline.

These must equal the behaviour being reproduced, so they are stated
plainly, in natural order, in one place.
"""

# ---- fixed values -----------------------------------------------------------
# Local zone of the collection windows (UTC+2, no daylight saving).
LOCAL_ZONE = "Africa/Johannesburg"

# Collection windows in local time: (start hour, start minute, end hour, end minute),
# half-open [start, end).
COLLECTION_WINDOWS = [
    (7, 50, 8, 0),
    (13, 50, 14, 0),
]

# Most ticks kept per symbol and window (600 seconds at one tick per second).
MAX_TICKS_PER_WINDOW = 600

# Symbols collected on weekends too (matched case-insensitively).
CRYPTO_SYMBOLS = [
    "BTCUSD", "ETHUSD", "LTCUSD", "XRPUSD", "BCHUSD",
    "ADAUSD", "DOTUSD", "SOLUSD", "DOGEUSD", "BNBUSD",
]

# Tick flags bitmask: 2 = bid changed, 4 = ask changed.
FLAG_BID = 2
FLAG_ASK = 4

# Tick CSV layout and text timestamp format (UTC, milliseconds).
CSV_COLUMNS = ["DateTime", "Bid", "Ask"]
TICK_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

# Config defaults.
DEFAULT_PREFIX = "raw"
DEFAULT_POLL_INTERVAL_MS = 200

# Terminal polling: ticks fetched per poll and first-poll look-back.
MAX_TICKS_PER_POLL = 5000
FIRST_POLL_LOOKBACK_MS = 2000

# Folder prefixes of the landing (CSV) and converted (Parquet) areas.
RAW_PREFIX = "raw"
PARQUET_PREFIX = "Training Batch"

# Gold table naming: ticks_<lower symbol>[_spread].
TABLE_PREFIX = "ticks_"
# ---- end of fixed values ----------------------------------------------------
