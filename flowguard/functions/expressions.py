"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowguard import schema as S

_INF = float("inf")

# Unicode-aware trim: Python's str.strip() also removes tabs, NBSP, the
# information separators 0x1C-0x1F, ...; Spark's trim() only removes spaces.
# btrim with the explicit set avoids a per-row regular expression.
_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())

# Textual numbers that pandas.to_numeric accepts: decimal / scientific
# notation, inf / infinity / nan with an optional sign.  try_cast alone is too
# generous (it takes Java suffixes like '1d' and hex floats).
NUMERIC_RE = (r"^\s*[+-]?(((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?"
              r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$")


def unicode_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WHITESPACE))


def label_key(c: Column) -> Column:
    """Normalised label key: stripped at both ends and upper-cased."""
    return F.upper(unicode_strip(c.cast("string")))


def is_nonfinite(c: Column) -> Column:
    """NaN, +Inf or -Inf (null stays null)."""
    return F.isnan(c) | (F.abs(c) == F.lit(_INF))


def finite_or_null(c: Column) -> Column:
    """+-Inf and NaN become null (pandas does not tell NaN from null)."""
    return F.when(~is_nonfinite(c), c)


def finite_or_zero(c: Column) -> Column:
    """+-Inf, NaN and null become 0.0."""
    return F.coalesce(finite_or_null(c), F.lit(0.0))


def round_half_even(c: Column, digits: int = 2) -> Column:
    """numpy.round semantics: half-even on the scaled value (not HALF_UP)."""
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def to_double_lenient(c: Column) -> Column:
    """pandas.to_numeric(errors='coerce'): number-shaped text -> double, else null."""
    s = c.cast("string")
    return F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))


def _map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*d.items())])


def family_of(label: Column, strict: bool = True) -> Column:
    """Raw label -> attack family.

    Dictionary lookup on the normalised key, then the web-attack prefix guard.
    ``strict`` raises (naming label and key) on an unknown label; otherwise
    the result is null so an audit query can list the offenders.
    """
    key = label_key(label)
    fam = F.coalesce(
        F.element_at(_map_literal(S.FAMILY_MAP), key),
        F.when(key.startswith(S.WEB_ATTACK_PREFIX), F.lit(S.WEB_ATTACK_FAMILY)),
    )
    if not strict:
        return fam
    msg = F.concat(F.lit("Label '"), label.cast("string"), F.lit("' (key '"), key,
                   F.lit("') is not in the family map"))
    return F.coalesce(fam, F.raise_error(msg).cast("string"))


def is_benign_label(label: Column) -> Column:
    return label_key(label) == F.lit(S.BENIGN_KEY)


def protocol_label(p: Column) -> Column:
    """Protocol number -> 'TCP (6)'; unknown number -> 'Outro (n)'.

    The number is truncated toward zero; text, NaN, Inf or out-of-range values
    are returned unchanged (as text).
    """
    s = p.cast("string")
    as_double = to_double_lenient(s)
    code = F.when(~is_nonfinite(as_double) & (F.abs(as_double) < F.lit(2.0 ** 31)),
                  as_double.cast("int"))
    name = F.coalesce(F.element_at(_map_literal(S.PROTOCOL_NAMES), code), F.lit(S.OTHER_PROTOCOL))
    return F.when(code.isNull(), s).otherwise(F.concat(name, F.lit(" ("), code.cast("string"), F.lit(")")))
