"""Column-level functions (measures, labels and formatting), all built-in
expressions: they stay inside whole-stage code generation."""

from martforge.functions.measures import (attainment_pct, avg_ticket, discount, discount_pct,
                                          guarded_pct, ratio_pct)
from martforge.functions.format import (attainment_band, deviation_sign, direction_label,
                                        fmt_int_dot, fmt_money, fmt_pct, month_label,
                                        rank_intensity, rank_label, target_label)

__all__ = [
    "attainment_pct", "avg_ticket", "discount", "discount_pct", "guarded_pct", "ratio_pct",
    "attainment_band", "deviation_sign", "direction_label", "fmt_int_dot", "fmt_money",
    "fmt_pct", "month_label", "rank_intensity", "rank_label", "target_label",
]
