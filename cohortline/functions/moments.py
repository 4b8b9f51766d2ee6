"""Closed-form extremes of a symmetric 3 x 3 matrix as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def symmetric_extremes(
    xx: str, yy: str, zz: str, xy: str, xz: str, yz: str
) -> tuple[Column, Column]:
    """Smallest and largest eigenvalue.

    The largest comes from the trigonometric solution of the characteristic
    cubic; the other two are then the roots of a quadratic, taken in the form
    that does not cancel.
    """
    mean = f"(({xx} + {yy} + {zz}) / 3)"
    off = f"({xy} * {xy} + {xz} * {xz} + {yz} * {yz})"
    on = " + ".join(f"({d} - {mean}) * ({d} - {mean})" for d in (xx, yy, zz))
    p = f"sqrt(({on} + 2 * {off}) / 6)"
    a, b, c = (f"({d} - {mean})" for d in (xx, yy, zz))
    shifted = (
        f"({a} * ({b} * {c} - {yz} * {yz}) - {xy} * ({xy} * {c} - {yz} * {xz})"
        f" + {xz} * ({xy} * {yz} - {b} * {xz}))"
    )
    det = (
        f"({xx} * ({yy} * {zz} - {yz} * {yz}) - {xy} * ({xy} * {zz} - {yz} * {xz})"
        f" + {xz} * ({xy} * {yz} - {yy} * {xz}))"
    )
    angle = f"acos(greatest(-1.0D, least(1.0D, {shifted} / (2 * {p} * {p} * {p})))) / 3"
    top = f"(CASE WHEN {p} = 0 THEN {mean} ELSE {mean} + 2 * {p} * cos({angle}) END)"
    rest = f"({xx} + {yy} + {zz} - {top})"
    product = f"({det} / nullif({top}, 0))"
    low = (
        f"coalesce(2 * {product} / nullif({rest} + "
        f"sqrt(greatest(0.0D, {rest} * {rest} - 4 * {product})), 0), 0.0D)"
    )
    return F.expr(low), F.expr(top)
