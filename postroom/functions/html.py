"""Small HTML text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The entities the fast path unescapes (``&amp;`` last).
BASIC_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
# ----------------------------------------------------------------------------


def unescape_basic(c: Column) -> Column:
    for ent, ch in BASIC_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c
