"""Column-level helpers (all JVM-side built-ins, no Python UDFs).

Timestamps of ticks are kept as ``timestamp_ntz`` holding UTC wall-clock
time, so nothing here depends on the session time zone: zone changes use
``convert_timezone`` and epoch arithmetic uses ``timestamp_diff`` /
``timestamp_add`` against the NTZ epoch.
"""

from __future__ import annotations

import re
import urllib.parse

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

__all__ = [
    "epoch_ntz", "utc_instant", "utc_wallclock", "to_ntz", "epoch_ms", "ms_to_ts", "ts_text", "parse_ts_text",
    "to_local", "to_utc", "minute_of_day", "local_weekday", "window_start_min",
    "window_start_ts", "window_end_min", "window_key", "second_key", "spread", "is_crypto",
    "flag_change", "path_symbol", "normalize_path", "output_key", "target_key",
    "year_of",
]

def epoch_ntz() -> Column:
    """1970-01-01 00:00:00 as timestamp_ntz."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c) -> Column:
    """Any timestamp → timestamp_ntz (LTZ values read in the session zone)."""
    return _c(c).cast("timestamp_ntz")


def epoch_ms(ts) -> Column:
    """UTC NTZ timestamp → epoch milliseconds, floored (X6 inverse)."""
    us = F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(ts))
    return ((us - F.pmod(us, F.lit(1000))) / 1000).cast("long")


def utc_instant(ts) -> Column:
    """UTC wall clock (ntz) → the same instant as a TIMESTAMP, session-zone free.

    Streaming watermarks need TIMESTAMP event times.
    """
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(ts)))


def utc_wallclock(ts) -> Column:
    """TIMESTAMP instant → UTC wall clock (ntz), session-zone free."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), epoch_ntz())


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds → UTC timestamp_ntz."""
    return F.timestamp_add("MILLISECOND", _c(ms), epoch_ntz())


def ts_text(ts) -> Column:
    """Timestamp → ``yyyy-MM-dd HH:mm:ss.SSS`` text, truncated to ms."""
    return F.date_format(_c(ts), K.TICK_TS_FORMAT)


def parse_ts_text(c, fmt: str = K.TICK_TS_FORMAT) -> Column:
    """UTC tick text → timestamp_ntz; bad text gives null instead of failing.

    The text is parsed with an explicit ``+0000`` offset and the instant
    turned into UTC wall clock, so the session time zone (and its daylight
    saving gaps) never shifts the value.
    """
    instant = F.try_to_timestamp(F.concat(_c(c), F.lit("+0000")), F.lit(fmt + "Z"))
    return utc_wallclock(instant)


def to_local(ts, zone: str = K.LOCAL_ZONE) -> Column:
    """UTC wall clock → local wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts))


def to_utc(ts, zone: str = K.LOCAL_ZONE) -> Column:
    """Local wall clock → UTC wall clock."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _c(ts))


def minute_of_day(ts) -> Column:
    return F.hour(_c(ts)) * 60 + F.minute(_c(ts))


def local_weekday(ts, zone: str = K.LOCAL_ZONE) -> Column:
    """Day of week of the local date, Monday = 0."""
    return F.weekday(to_local(ts, zone))


def _windows_minutes(windows):
    return [(sh * 60 + sm, eh * 60 + em) for sh, sm, eh, em in windows]


def window_start_min(local_ts, windows=K.COLLECTION_WINDOWS) -> Column:
    """Start minute of the half-open window holding ``local_ts``, else null.

    The window list is a small constant, so membership is a CASE chain
    inside whole-stage codegen rather than a join.
    """
    m = minute_of_day(local_ts)
    expr = None
    for ws, we in _windows_minutes(windows):
        cond = (m >= ws) & (m < we)
        expr = F.when(cond, F.lit(ws)) if expr is None else expr.when(cond, F.lit(ws))
    return expr.otherwise(F.lit(None).cast("int"))


def window_end_min(start_min, windows=K.COLLECTION_WINDOWS) -> Column:
    """End minute (exclusive) of the window starting at ``start_min``."""
    expr = None
    for ws, we in _windows_minutes(windows):
        cond = _c(start_min) == ws
        expr = F.when(cond, F.lit(we)) if expr is None else expr.when(cond, F.lit(we))
    return expr


def window_start_ts(local_date, start_min) -> Column:
    """Local window start timestamp from a local date and a start minute."""
    return F.timestamp_add("MINUTE", _c(start_min),
                           F.to_date(_c(local_date)).cast("timestamp_ntz"))


def window_key(local_date, start_min) -> Column:
    """``yyyyMMdd_HHmm`` of a window start."""
    sm = _c(start_min)
    hhmm = F.lpad(((F.floor(sm / 60) * 100) + F.pmod(sm, F.lit(60))).cast("string"), 4, "0")
    return F.concat(F.date_format(_c(local_date), "yyyyMMdd"), F.lit("_"), hhmm)


def second_key(ts) -> Column:
    """Timestamp truncated to its second."""
    return F.date_trunc("second", _c(ts)).cast("timestamp_ntz")


def spread(ask="Ask", bid="Bid") -> Column:
    """Ask − Bid floored at 0; null when either side is null."""
    a, b = _c(ask), _c(bid)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")) \
        .otherwise(F.greatest(a - b, F.lit(0.0)))


def is_crypto(symbol, crypto=K.CRYPTO_SYMBOLS) -> Column:
    """Case-insensitive membership in the crypto set."""
    return F.upper(_c(symbol)).isin([s.upper() for s in crypto])


def flag_change(flags) -> Column:
    """Tick changed bid or ask (F1)."""
    return F.col(flags).bitwiseAND(K.FLAG_BID | K.FLAG_ASK) != 0 if isinstance(flags, str) \
        else flags.bitwiseAND(K.FLAG_BID | K.FLAG_ASK) != 0


def normalize_path(c, encoded: bool = True) -> Column:
    """Percent-decoded path without the scheme's empty authority.

    ``_metadata.file_path`` is percent-encoded while file listings are not
    (``encoded=False``); decode ``%xx`` only (a literal ``+`` stays a plus),
    turn ``file:///`` into ``file:/`` and give a plain local path its scheme,
    so all spellings compare equal.
    """
    path = F.url_decode(F.regexp_replace(_c(c), r"\+", "%2B")) if encoded else _c(c)
    decoded = F.when(path.startswith("/"), F.concat(F.lit("file:"), path)).otherwise(path)
    return F.regexp_replace(decoded, r"^([a-zA-Z][a-zA-Z0-9+.-]*):///", "$1:/")


def path_symbol(path, prefix: str = K.RAW_PREFIX, encoded: bool = True) -> Column:
    """Symbol folder right below ``prefix`` in a file path; null if none.

    Accepts both ``prefix/SYM/file`` and Hive-style ``prefix/symbol=SYM/file``.
    ``encoded`` says the path is percent-encoded (``_metadata.file_path``),
    so the prefix is encoded the same way before being regex-escaped.
    """
    p = urllib.parse.quote(prefix) if encoded else prefix
    pattern = ".*/" + re.escape(p) + "/(?:symbol=)?([^/]+)/.*"
    return F.nullif(F.regexp_extract(_c(path), pattern, 1), F.lit(""))


def output_key(symbol, local_date, start_min, prefix: str = K.DEFAULT_PREFIX,
               ext: str = "csv") -> Column:
    """``prefix/SYM/SYM_yyyyMMdd_HHmm.csv``."""
    sym = F.upper(_c(symbol))
    return F.concat(F.lit(prefix + "/"), sym, F.lit("/"), sym, F.lit("_"),
                    window_key(local_date, start_min), F.lit("." + ext))


def target_key(key, raw_prefix: str = K.RAW_PREFIX,
               parquet_prefix: str = K.PARQUET_PREFIX) -> Column:
    """Swap the leading prefix and the last extension for ``.parquet``."""
    k = _c(key)
    rel = k.substr(F.lit(len(raw_prefix) + 2), F.length(k))
    stem = F.regexp_replace(rel, r"\.[^.]*$", "")
    return F.concat(F.lit(parquet_prefix + "/"), stem, F.lit(".parquet"))


def year_of(ts) -> Column:
    return F.year(_c(ts)).cast("int")
