"""Vector expressions on arrays."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ticketlake.functions import cleanse as X


def as_double(v) -> Column:
    return X._c(v).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a) -> Column:
    """Unit vector; a zero vector stays zero."""
    size = norm(a)
    return F.transform(as_double(a), lambda x: F.when(size == 0, 0.0).otherwise(x / F.nullif(size, F.lit(0.0))))


def fuse_levels(vector, priority, urgency, impact, scale: float = 5.0) -> Column:
    """Append level features divided by ``scale`` (missing as zero) and renormalise."""
    extra = F.array(*[F.coalesce(X._c(c).cast("double"), F.lit(0.0)) / scale for c in (priority, urgency, impact)])
    return l2_normalize(F.concat(as_double(vector), extra))


def fuse_query(vector, priority=0.0, urgency=0.0, impact=0.0, scale: float = 5.0) -> Column:
    """The query side of `fuse_levels`: the asked levels, or zero, behind the unit query vector, renormalised."""
    return fuse_levels(l2_normalize(vector), *(x if isinstance(x, Column) else F.lit(float(x)) for x in (priority, urgency, impact)), scale)
