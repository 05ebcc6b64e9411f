"""Column-expression helpers. All built-in functions: JVM side, codegen'd."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rating ladder (fractions of mean hours times weight),
# highest rung first, with the rating each rung gives.
LADDER = [(0.9, 5), (0.7, 4), (0.4, 3), (0.1, 2)]
# Rating when hours equal mean times weight exactly; rating below all rungs.
EQUAL_RATING = 1
BELOW_RATING = 0
# Behaviour values of the log.
PURCHASE = "purchase"
PLAY = "play"


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """Deterministic bucket of a string key: first 32 bits of md5, mod n.

    Same value as DuckDB ``('0x' || substr(md5(key), 1, 8))::BIGINT % n``.
    """
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def in_train(key: Column, train_pct: int = 80) -> Column:
    """True for the train side of the deterministic 80/20 split."""
    return hash_bucket(key) < F.lit(train_pct)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 (Spark 4 ANSI would raise)."""
    return F.try_divide(num, den)


def rnd(c: Column, digits: int = 6) -> Column:
    """Round a double for output: ``round(x * 10^d) / 10^d``, half away from
    zero on the binary value (as most SQL engines round doubles; Spark's
    ``round(x, d)`` rounds the decimal string instead, which differs on exact
    halves). ``+ 0.0`` turns a negative zero into zero."""
    m = F.lit(float(10 ** digits))
    return F.round(c.cast("double") * m) / m + F.lit(0.0)


def steady_mean(c: Column) -> Column:
    """Mean of a column per group. Where all values are equal it is that value
    itself: a sum divided by the count could miss it by a last bit, in an
    order-dependent way, and the rating ladder tests for equality."""
    return F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.avg(c))


def rank_key(c: Column, digits: int) -> Column:
    """Ranking key: ``c`` rounded to ``digits`` places the same way as
    ``rnd`` (kept scaled; the order is what matters)."""
    return F.round(c.cast("double") * F.lit(float(10 ** digits)))


def conversion_weight(prev: Column, behaviour: Column) -> Column:
    """2 when a purchase is followed by play of the next row, else 1."""
    return (F.when((prev == F.lit(PURCHASE)) & (behaviour == F.lit(PLAY)), F.lit(2))
            .otherwise(F.lit(1)))


def transition_keep(prev: Column, behaviour: Column, profile: str,
                    keep_first: bool = False) -> Column:
    """Row filter on (previous behaviour, behaviour).

    profile 'als': purchase->play, purchase->purchase, play->purchase.
    profile 'knn': purchase->play, purchase->purchase, play->play.
    keep_first adds (no previous row)->purchase.
    """
    pu, pl = F.lit(PURCHASE), F.lit(PLAY)
    pairs = {
        "als": [(pu, pl), (pu, pu), (pl, pu)],
        "knn": [(pu, pl), (pu, pu), (pl, pl)],
    }[profile]
    cond = None
    for p, b in pairs:
        term = (prev == p) & (behaviour == b)
        cond = term if cond is None else (cond | term)
    if keep_first:
        cond = cond | (prev.isNull() & (behaviour == pu))
    return cond


def rating_ladder(hours: Column, mean: Column, weight: Column) -> Column:
    """0..5 rating from hours relative to the item mean times the weight.

    First match wins: exact equality gives 1, then the rungs of LADDER from
    the top, else 0. NULL hours fall through to 0.
    """
    expr = F.when(hours == mean * weight, F.lit(EQUAL_RATING))
    for frac, rating in LADDER:
        expr = expr.when(hours >= F.lit(frac) * mean * weight, F.lit(rating))
    return expr.otherwise(F.lit(BELOW_RATING))
