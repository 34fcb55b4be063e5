"""Report labels and number formatting as column expressions.

``format_number`` rounds the exact binary value half-to-even, like Python's
format spec, so it is used instead of ``format_string('%.1f')`` (which
rounds the decimal text half-up and differs on values such as 1.25).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations (Portuguese), in month order 1..12.
MONTH_ABBREVIATIONS = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun",
                       "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
# Status classes and labels used by the report.
GOOD, WARNING, BAD = "green", "yellow", "red"
UP_ARROW, DOWN_ARROW = "▲", "▼"
ABOVE_TARGET, BELOW_TARGET = "acima da meta", "abaixo da meta"
CURRENCY = "R$ "


def _plain(c: Column, digits: int) -> Column:
    """Fixed-point text without thousands separators."""
    return F.translate(F.format_number(c, digits), ",", "")


def fmt_money(v: Column) -> Column:
    """R$ x.xxM from one million, R$ x.xK from one thousand, else R$ x,xxx.xx."""
    x = v.cast("double")
    a = F.abs(x)
    return (
        F.when(a >= 1_000_000, F.concat(F.lit(CURRENCY), _plain(x / 1_000_000, 2), F.lit("M")))
        .when(a >= 1_000, F.concat(F.lit(CURRENCY), _plain(x / 1_000, 1), F.lit("K")))
        .otherwise(F.concat(F.lit(CURRENCY), F.format_number(x, 2)))
    )


def fmt_int_dot(q: Column) -> Column:
    """Integer part with '.' as thousands separator (1.234.567)."""
    return F.translate(F.format_number(q.cast("bigint"), 0), ",", ".")


def fmt_pct(x: Column, digits: int = 1) -> Column:
    return F.concat(_plain(x.cast("double"), digits), F.lit("%"))


def month_label(mes: Column) -> Column:
    """Month number -> abbreviation; NULL outside 1..12."""
    pairs = []
    for i, name in enumerate(MONTH_ABBREVIATIONS, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.try_element_at(F.create_map(*pairs), mes.cast("int"))


def attainment_band(pct: Column) -> Column:
    """>= 100 green, >= 85 yellow, otherwise red (NULL stays NULL)."""
    return F.when(pct >= 100, F.lit(GOOD)).when(pct >= 85, F.lit(WARNING)).when(
        pct.isNotNull(), F.lit(BAD))


def deviation_sign(dev: Column) -> Column:
    return F.when(dev >= 0, F.lit(GOOD)).when(dev.isNotNull(), F.lit(BAD))


def direction_label(dev: Column) -> Column:
    """'▲ R$ 1.2K vs meta' (zero counts as up)."""
    arrow = F.when(dev >= 0, F.lit(UP_ARROW)).otherwise(F.lit(DOWN_ARROW))
    return F.concat(arrow, F.lit(" "), fmt_money(F.abs(dev)), F.lit(" vs meta"))


def target_label(pct: Column) -> Column:
    return F.when(pct >= 100, F.lit(ABOVE_TARGET)).otherwise(F.lit(BELOW_TARGET))


def rank_intensity(i: Column, n: Column) -> Column:
    """0.45 + 0.55 * i / max(n - 1, 1), as text with 2 decimals."""
    step = (F.lit(0.55) * i.cast("double")) / F.greatest(n - 1, F.lit(1)).cast("double")
    return F.format_number(F.lit(0.45) + step, 2)


def rank_label(value: Column, pct: Column) -> Column:
    """'  R$ 1.2M  97%' bar label."""
    return F.concat(F.lit("  "), fmt_money(value), F.lit("  "), _plain(pct.cast("double"), 0),
                    F.lit("%"))
