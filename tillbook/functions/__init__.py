"""Column functions (F01-F12, P03-P06, G04, G05): built-in expressions only, no Python UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- F01 / F02: time ------------------------------------------------------------------------

def trunc_ts(unit: str, ts: ColumnOrName) -> Column:
    """``date_trunc`` that keeps a zone-less timestamp zone-less (Spark returns TIMESTAMP)."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def ts_lit(value: str) -> Column:
    """An as-of literal as TIMESTAMP_NTZ (the driver tables carry zone-less times)."""
    return F.lit(value).cast("timestamp_ntz")


def week_start(d: ColumnOrName) -> Column:
    """Monday of the week (X6: WEEKDAY is 0 on Monday)."""
    day = _c(d).cast("date")
    return F.date_sub(day, F.weekday(day))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``extract(epoch from end - start)`` as a double with microsecond precision."""
    return (F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))) / F.lit(1_000_000.0)


# ---- F07 / F11: rounding rules on money (X2, X3, X5) ----------------------------------------

def round_half_up(c: ColumnOrName, scale: int = 2) -> Column:
    """SQL ``round(numeric)``: half away from zero."""
    return F.round(_c(c), scale)


def money(c: ColumnOrName, scale: int = 2) -> Column:
    """Python ``Decimal.quantize`` default: half-even to cents."""
    return F.bround(_c(c), scale)


def signed(c: ColumnOrName) -> Column:
    """MySQL ``CAST(decimal AS SIGNED)`` rounds half away from zero (X5); Spark's cast truncates."""
    return F.round(_c(c), 0).cast("long")


# ---- B02 / B03 / F06: deterministic picks -------------------------------------------------

def pick(idx: ColumnOrName, values: Sequence) -> Column:
    """Cyclic pick from a literal list: ``values[idx mod n]`` (pmod keeps negatives in range)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(_c(idx), F.lit(len(values))) + 1).cast("int"))


# A draw is a 32-bit integer hash written with BIGINT arithmetic only (every product stays
# below 2^63, so ANSI mode never overflows), which DuckDB evaluates identically: the builds
# that use draws keep exact oracles (``uniform_sql``). Keys are folded into one 32-bit value
# by a polynomial, then mixed by two multiply / xor-shift rounds.
_M32 = 1 << 32
_KEY_MUL = 1640531527   # odd, below 2^31
_HI_MUL = 1327217885    # folds the high 32 bits of a key
_MIX = 73244475


def _draw_base(seed: int, draw: int) -> int:
    return (seed * 1000003 + draw * 7919) % _M32


def _long(v: int) -> Column:
    return F.lit(v).cast("bigint")


def uniform(seed: int, draw: int, *keys: ColumnOrName) -> Column:
    """A reproducible draw in [0, 1) from ``(seed, draw, keys)`` (replaces random())."""
    m = _long(_M32)
    h = _long(_draw_base(seed, draw))
    for k in keys:
        k = _c(k).cast("bigint")
        x = F.pmod(F.pmod(k, m) + F.pmod(F.shiftright(k, 32), m) * _long(_HI_MUL), m)
        h = F.pmod(h * _long(_KEY_MUL) + x, m)
    for _ in range(2):
        h = F.pmod(F.shiftright(h, 16).bitwiseXOR(h) * _long(_MIX), m)
    h = F.shiftright(h, 16).bitwiseXOR(h)
    return h.cast("double") / float(_M32)


def uniform_sql(seed: int, draw: int, *keys: str) -> str:
    """The same draw as DuckDB SQL text over the key expressions ``keys`` (for oracles)."""
    m = _M32

    def pmod(x: str) -> str:
        return f"((({x}) % {m} + {m}) % {m})"

    h = f"CAST({_draw_base(seed, draw)} AS BIGINT)"
    for k in keys:
        kb = f"CAST({k} AS BIGINT)"
        x = pmod(f"{pmod(kb)} + {pmod(f'{kb} >> 32')} * {_HI_MUL}")
        h = pmod(f"({h}) * {_KEY_MUL} + {x}")
    for _ in range(2):
        h = f"((xor(({h}) >> 16, ({h})) * {_MIX}) % {m})"
    h = f"xor(({h}) >> 16, ({h}))"
    return f"(CAST({h} AS DOUBLE) / {float(m)})"


def skewed_key(u: ColumnOrName, lo: ColumnOrName, n: ColumnOrName, k: float) -> Column:
    """Power-law key ``lo + floor(u^k * n)``: small keys are hot."""
    return (_c(lo) + F.floor(F.pow(_c(u), F.lit(k)) * _c(n))).cast("long")


def skewed_key_sql(u: str, lo: str, n: str, k: float) -> str:
    """``skewed_key`` as DuckDB SQL text."""
    return f"CAST(({lo}) + floor(pow({u}, {k}) * ({n})) AS BIGINT)"


def stable_uuid(*parts: ColumnOrName) -> Column:
    """Deterministic 36-char key in place of UUID(): md5 of the parts, dashed as a UUID."""
    h = F.md5(F.concat_ws("|", *[_c(p).cast("string") for p in parts]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


# ---- P03 / P04 / P05 / P06: predicates and classifiers ------------------------------------

def changed(old: ColumnOrName, new: ColumnOrName) -> Column:
    """``old IS DISTINCT FROM new``."""
    return ~_c(old).eqNullSafe(_c(new))


# Fixed values (must equal the reference): database error codes -> request result labels.
PG_ERROR_KINDS = {"55P03": "lock_timeout", "57014": "canceled", "40P01": "deadlock", "40001": "serialization",
                  "25P03": "idle_in_tx_timeout"}
PG_CONNECTION_STATES = ("57P01", "57P02", "57P03")
MYSQL_ERROR_KINDS = {1205: "lock_timeout", 1213: "deadlock", 3024: "query_timeout", 1317: "killed",
                     1040: "too_many_connections", 1203: "too_many_connections", 1226: "too_many_connections",
                     1044: "denied", 1045: "denied", 1142: "denied", 1143: "denied", 1146: "missing_table",
                     3819: "check_violation"}
MYSQL_CONNECTION_ERRORS = (1053, 1927, 2003, 2006, 2013, 2055, 4031)
# Business outcomes of the sportsbook (a refused request, not an error).
BUSINESS_OUTCOMES = ("insufficient_funds", "odds_changed", "market_suspended", "limit_reached", "blocked",
                     "kyc_required", "declined", "nothing_to_do", "out_of_stock")


def _map(table: dict) -> Column:
    return F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])


def classify_error(code: ColumnOrName, dialect: str = "pg") -> Column:
    """Error code -> result label (P05): known codes by lookup, connection errors by rule, else 'other'.

    PostgreSQL: a missing SQLSTATE, class 08 and 57P01-03 are connection errors.
    MySQL: the listed client/server codes are connection errors.
    """
    c = _c(code)
    if dialect == "pg":
        s = c.cast("string")
        conn = s.isNull() | s.startswith("08") | s.isin(*PG_CONNECTION_STATES)
        known = F.element_at(_map(PG_ERROR_KINDS), s)
    else:
        n = c.cast("int")
        conn = n.isin(*MYSQL_CONNECTION_ERRORS)
        known = F.element_at(_map(MYSQL_ERROR_KINDS), n)
    return F.coalesce(known, F.when(conn, F.lit("connection")), F.lit("other"))


def outcome_class(result: ColumnOrName) -> Column:
    """ok / business (an expected refusal) / error."""
    r = _c(result)
    return F.when(r == "ok", "ok").when(r.isin(*BUSINESS_OUTCOMES), "business").otherwise("error")


def prom_match(c: ColumnOrName, op: str, pattern: str) -> Column:
    """PromQL label matcher: ``=``, ``!=``, ``=~``, ``!~`` (regexes are fully anchored)."""
    c = _c(c)
    if op == "=":
        return c == pattern
    if op == "!=":
        return c != pattern
    anchored = c.rlike(f"^(?:{pattern})$")
    return anchored if op == "=~" else ~anchored


# ---- G04: opening odds --------------------------------------------------------------------

# The seven selections of a match, in order, with their market.
SELECTION_NAMES = (("match_result", "home"), ("match_result", "draw"), ("match_result", "away"),
                   ("over_under_2_5", "over"), ("over_under_2_5", "under"),
                   ("both_teams_score", "yes"), ("both_teams_score", "no"))


def implied_odds(event_id: ColumnOrName) -> Column:
    """Opening odds of a match, ``array<decimal(7,2)>`` of the seven selections (6% margin).

    Probabilities are doubles (X13) from hashes of the id by three primes; odds are
    ``round(1 / (1.06 p), 2)`` floored at 1.01 (X10).
    """
    e = _c(event_id)

    def frac(prime: int) -> Column:
        return F.pmod(e * F.lit(prime), F.lit(1000)).cast("double") / F.lit(1000.0)

    p_home = F.lit(0.15e0) + F.lit(0.6e0) * frac(7919)
    p_away = (F.lit(1.0e0) - p_home) * F.lit(0.62e0)
    p_over = F.lit(0.35e0) + F.lit(0.35e0) * frac(104729)
    p_yes = F.lit(0.35e0) + F.lit(0.35e0) * frac(1299709)
    probs = [p_home, F.lit(1.0e0) - p_home - p_away, p_away, p_over, F.lit(1.0e0) - p_over, p_yes,
             F.lit(1.0e0) - p_yes]
    return F.array(*[F.greatest(F.lit(1.01e0), F.round(F.lit(1.0e0) / (F.lit(1.06e0) * p), 2))
                     .cast("decimal(7,2)") for p in probs])


def selection_result(name: ColumnOrName, home: ColumnOrName, away: ColumnOrName) -> Column:
    """won / lost of a selection from the final score."""
    n, h, a = _c(name), _c(home), _c(away)
    won = (((n == "home") & (h > a)) | ((n == "draw") & (h == a)) | ((n == "away") & (h < a))
           | ((n == "over") & (h + a > 2)) | ((n == "under") & (h + a < 3))
           | ((n == "yes") & (h > 0) & (a > 0)) | ((n == "no") & ((h == 0) | (a == 0))))
    return F.when(won, "won").otherwise("lost")


# Latency histogram bounds in seconds (5 ms .. 30 s).
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0)
