"""Column expressions for the business rules. All stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridledger import params as P


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_sentinel(c: Column | str, values: Sequence[str], prefixes: Iterable[str] = ()) -> Column:
    """True when the value counts as missing (null stays null)."""
    hit = col(c).isin(*values)
    return reduce(lambda acc, p: acc | col(c).startswith(p), prefixes, hit)


def nullify_sentinels(c: Column | str, values: Sequence[str], prefixes: Iterable[str] = ()) -> Column:
    return F.when(~is_sentinel(c, values, prefixes), col(c))


def has_point(c: Column | str = "PDP") -> Column:
    """A real supply point: neither null, nor a sentinel, nor a placeholder."""
    return nullify_sentinels(c, P.POINT_SENTINELS, P.POINT_PLACEHOLDER_PREFIXES).isNotNull()


def party_key() -> tuple[Column, Column]:
    """First usable party key and the label of its origin.

    Vat and tax code are tested as one value, so a sentinel vat hides a valid
    tax code of the same party.
    """
    offer = nullify_sentinels(F.coalesce("P_IVA_OFFERTABILE", "COD_FISC_OFFERTABILE"), P.PARTY_SENTINELS)
    holder = nullify_sentinels(F.coalesce("P_IVA_TITOLARE", "COD_FISC_TITOLARE"), P.PARTY_SENTINELS)
    key = F.coalesce(offer, holder, "RAG_SOC_OFFERTABILE", "CLIENTE")
    origin = (
        F.when(offer.isNotNull(), P.ORIGIN_OFFER)
        .when(holder.isNotNull(), P.ORIGIN_HOLDER)
        .otherwise(P.ORIGIN_NAME)
    )
    return key, origin


def is_regular_offer(c: Column | str = "COD_OFFERTA") -> Column:
    """Neither a fixing nor a reversal; null for a null code, which filters drop."""
    return ~col(c).like("%F%") & ~col(c).like("S-%")


def carries_components(offer: Column | str = "COD_OFFERTA", kind: Column | str = "DES_TIPO_CONTRATTO") -> Column:
    """Offers that get components: no fixing, and no reversal but the generic one."""
    return (~col(offer).like("S-%") | (col(kind) == "Storno generico")) & ~col(offer).like("%F%")


def month_diff(later: Column | str, earlier: Column | str) -> Column:
    """Number of month boundaries between two dates."""
    return F.months_between(F.trunc(col(later), "MM"), F.trunc(col(earlier), "MM")).cast("int")


def strip_version(c: Column | str = "COD_OFFERTA") -> Column:
    """Opportunity code: the offer code without its version suffixes.

    The suffixes go one after the other, because one removal can form another.
    """
    return reduce(lambda acc, s: F.replace(acc, F.lit(s), F.lit("")), P.VERSION_SUFFIXES, col(c))


def before_f(c: Column | str) -> Column:
    """Text before the first ``F`` (the whole text when there is none)."""
    return F.get(F.split(col(c), "F"), F.lit(0))


def commodity(c: Column | str = "VETTORE") -> Column:
    return F.when(col(c) == "ELE", "E").when(col(c) == "GAS", "G").otherwise("ND")


def weighted_bands(values: Sequence[Column], volumes: Sequence[Column], total: Column) -> Column:
    """Volume-weighted mean of band values; null when the total is null or zero."""
    parts = reduce(lambda a, b: a + b, [v * q for v, q in zip(values, volumes)])
    return F.when(total != 0, parts / F.nullif(total, F.lit(0.0)))


def tender_agreement(c: Column | str = "SETTORE") -> Column:
    """Public-tender agreement encoded in the sector text of a payment method."""
    return F.when(col(c).like("CON__L%"), F.concat(F.lit("CONSIP"), F.substring(col(c), 4, 2))).when(
        col(c).startswith("CON2880"), "CONSIP23"
    )


def tender_lot(c: Column | str = "SETTORE") -> Column:
    """Lot: the two last characters of the first eight, or of the first ten."""
    return F.when(col(c).like("CON__L%"), F.right(F.left(col(c), F.lit(8)), F.lit(2))).when(
        col(c).startswith("CON2880"), F.right(F.left(col(c), F.lit(10)), F.lit(2))
    )


def usage_class(code: Column | str, fallback: Column | str) -> Column:
    decoded = F.when(col(code).isin("0", "1"), "DOM").when(col(code) == "2", "AU").when(col(code) == "3", "IP")
    return F.coalesce(decoded, col(fallback), F.lit("AU"))
