"""Label and code helpers (F-07..F-11, F-21, F-25)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagic.functions.nulls import _c, first_word


def code_map(c: str | Column, mapping: Mapping[str, str], default: str | Column | None = None) -> Column:
    """F-07: code -> name through a literal map, with a default for unknown codes."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = F.element_at(m, _c(c)) if mapping else F.lit(None).cast("string")
    if default is None:
        return out
    return F.coalesce(out, default if isinstance(default, Column) else F.lit(default))


def pad_left(c: str | Column, width: int, pad: str = "0") -> Column:
    """F-10 / N-17: left pad that never truncates (``lpad`` cuts long text)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, pad))


def sample_code(prefix: str | Column, trip: str | Column, depth: str | Column, width: int = 3) -> Column:
    """F-10: ``<prefix><trip>_<ddd|WC>``; numeric depths are zero padded, text kept."""
    d = _c(depth).cast("string")
    padded = F.when(d.rlike(r"^[0-9]+$"), pad_left(d, width)).otherwise(d)
    p = prefix if isinstance(prefix, Column) else F.lit(prefix)
    return F.concat(p, _c(trip).cast("string"), F.lit("_"), padded)


def genus_species(genus: str | Column, species: str | Column, bin_complex: bool = True) -> Column:
    """F-09: ``Genus species`` label; with ``bin_complex`` only the first word of species is kept.

    A null genus or species gives null (R would print the text "NA"; see N-9).
    """
    sp = first_word(species) if bin_complex else _c(species)
    return F.concat(_c(genus), F.lit(" "), sp)


def depth_bin(depth: str | Column, edges: Sequence[float] = (0, 20, 40, 60, 80, 100)) -> Column:
    """F-11 / N-16: right-closed bins (lo, hi]; outside -> null.  Label ``"lo - him"``."""
    d = _c(depth)
    expr = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        label = F.lit(f"{_num(lo)} - {_num(hi)}m")
        cond = (d > F.lit(lo)) & (d <= F.lit(hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def _num(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def whole_number_text(c: str | Column) -> Column:
    """F-25: numeric -> text, printing whole numbers without ``.0``."""
    x = _c(c)
    return F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))
