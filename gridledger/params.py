"""Run parameters and fixed business values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --- fixed values: labels, codes and patterns the results must carry ---------

PARTY_SENTINELS = ("ND", "00000000000", "***")
POINT_SENTINELS = ("00000000000000", "***", "ND")
POINT_PLACEHOLDER_PREFIXES = ("DSB", "SA-")

ORIGIN_OFFER = "PIVA_OFFERTABILE o CFISC_OFFERTABILE"
ORIGIN_HOLDER = "PIVA_TITOLARE o CFISC_TITOLARE"
ORIGIN_NAME = "RAG_SOC_OFFERTABILE o CLIENTE"

ALWAYS_POINT = "PIVA_CFISC_FORECAST ha sempre il pdp"
NEVER_POINT = "PIVA_CFISC_FORECAST non ha mai il pdp"
SOMETIMES_POINT = "PIVA_CFISC_FORECAST non ha sempre il pdp"

NOTE_BOOKED = "Coda"
NOTE_LAPSED = "Coda di cliente cessato"
NOTE_PROJECTED = "Proiezione"
NOTE_REPLACING = "Proiezione che sostituisce coda"
NOTE_REPLACED = "Coda da sostituire con proiezione"
NOTE_GAP = "Proiezione da buco"

WHY_LATEST_POINT = "SI perchè il record ha la massima competenza per mese dell anno e pdp"
WHY_FUTURE = "SI perchè rank 1 ha competenza futura e il record ha passato il check sui volumi"
WHY_SINGLE = "SI perchè ha solo rank 1"
WHY_PAST = "SI perchè rank 1 ha competenza passata"
WHY_MEAN = "Media mensile perchè manca indicazione storica"

GAP_FILL = "Buchi da proiettare"
GAP_SKIP = "Buchi da NON proiettare"

OFFER_REQUEST_SYSTEMS = ("B2Be", "SMS")
OPPORTUNITY_REQUEST_SYSTEMS = ("SFA",)
PASS_THROUGH_SYSTEMS = ("EXTRA SISTEMA", "MMK")
OPPORTUNITY_REQUEST_STATES = (3, 4, 12, 41, 43, 60, 62, 81, 86)

VERSION_SUFFIXES = (
    "_02A", "_02B", "_02C", "_02D", "_02E",
    "_01A", "_01B", "_01C", "_01D", "_01E",
    "_02", "_01",
)

TENDER_LOTS = {
    "CONSIP19": ("12",),
    "CONSIP20": ("02", "08", "09", "12"),
    "CONSIP21": ("02", "03", "06", "08", "09", "12"),
    "CONSIP22": ("02", "03", "06", "07", "08", "09", "10", "12", "13", "16", "17"),
    "CONSIP23": ("12", "18"),
}

FIXED_PRICE_GAS = "PREZZO FISSO GAS"
FIXED_PRICE_POWER = "PREZZO FISSO EE"
PROFILED_INDICES = ("PUN FASCE", "PSVDA_MM", "PSVDA")
PLACEHOLDER_SOURCE = "DEVO ANCORA INVENTARLO"
SOURCE_CORE = "GECO"
SOURCE_CLOUD = "GCP"
SOURCE_SELLER_SNAPSHOT = "FOTOGRAFIA_VENDITORI_OLD"
SOURCE_RELATED_PARTY = "RESELLER_E_INTERCOMPANY"
NEVER_PUBLISHED_OFFER = "%MMK%"
EXTERNAL_OFFER = "%EXT%"
UNPUBLISHED_NAME_PATTERNS = ("%STM %", "%STG %", "%STD %")
UNPUBLISHED_NAME = "Salvaguardia"
IMPORTED_COVERAGE = "2025-11-14 00:00:00"


def add_months(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` after the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class ForecastParams:
    """Forecast run. ``as_of`` replaces every clock read.

    ``row_key`` names columns that identify an input row, which the plan checks; with
    it the plan skips the removal of identical projected rows. ``None`` makes no
    assumption.
    """

    as_of: dt.date
    tolerance_pct: int = 15
    lapse_months: int = 3
    row_key: tuple[str, ...] | None = None

    @property
    def scenario_end(self) -> dt.date:
        return dt.date(self.as_of.year + 3, 1, 1)

    @property
    def lapse_cutoff(self) -> dt.date:
        return add_months(self.as_of, -self.lapse_months)

    @property
    def calendar(self) -> list[dt.date]:
        """Months from next month on; the scenario-end month enters on the 1st only."""
        last = self.scenario_end if self.as_of.day == 1 else add_months(self.scenario_end, -1)
        months, month = [], add_months(self.as_of, 1)
        while month <= last:
            months.append(month)
            month = add_months(month, 1)
        return months


@dataclass(frozen=True)
class KeysParams:
    """Scope of the key set. ``offer_pattern`` restricts it to one offer family."""

    delivery_from: dt.date = dt.date(2024, 1, 1)
    offer_pattern: str | None = None
    covered_states: tuple[int, ...] = (5,)
    special_price_states: tuple[int, ...] = (8,)
    default_voltage: float = 4.0


@dataclass(frozen=True)
class RelatedPartyRules:
    """Sales attributes of intercompany and reseller customers.

    Company codes and people are data of the user, so they come as parameters.
    """

    group_vats: tuple[str, ...] = ()
    group_area: str | None = None
    other_area: str = "Altri IC"
    intercompany_seller: str | None = None
    intercompany_manager: str | None = None
    reseller_manager: str | None = None


@dataclass(frozen=True)
class MasterParams:
    """Master run. ``enve_volume`` picks net or gross green-energy volumes."""

    as_of: dt.date
    related: RelatedPartyRules = field(default_factory=RelatedPartyRules)
    tender_lots: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(TENDER_LOTS))
    enve_volume: str = "NETTO"
    subtract_seller_fee: bool = False
    product_change_type: str = "CP001"
