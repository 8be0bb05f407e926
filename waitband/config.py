"""Band layout, column names and thresholds.

Everything that depends on the shape of the monthly extract lives here, so
the same operators work on any banded-count table: pass a different
``BandSpec`` / ``Thresholds`` and the column lists are regenerated.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class BandSpec:
    """Week-of-wait bands: ``n_bands`` closed bands plus one open band.

    Band ``i`` (``0 <= i < n_bands``) holds waits in ``(i, i+1]`` weeks; the
    last band holds waits over ``n_bands`` weeks.  Raw and staging names are
    generated from the index, never hand-listed.
    """

    n_bands: int = 104

    @property
    def count(self) -> int:
        return self.n_bands + 1

    def raw_name(self, i: int) -> str:
        if i == self.n_bands:
            return f"Gt {self.n_bands} Weeks SUM 1"
        return f"Gt {i:02d} To {i + 1:02d} Weeks SUM 1"

    def name(self, i: int) -> str:
        if i == self.n_bands:
            return f"wks_over_{self.n_bands}"
        return f"wks_{i:02d}_to_{i + 1:02d}"

    def raw_names(self) -> list[str]:
        return [self.raw_name(i) for i in range(self.count)]

    def names(self) -> list[str]:
        return [self.name(i) for i in range(self.count)]

    def names_between(self, lo: int, hi: int | None = None) -> list[str]:
        """Staging names of bands ``lo <= i < hi`` (``hi=None``: to the open band)."""
        hi = self.count if hi is None else hi
        return [self.name(i) for i in range(lo, hi)]

    def midpoint(self, i: int) -> float:
        """Representative wait (weeks) of band ``i``; the open band uses i + 0.5."""
        return i + 0.5


BANDS = BandSpec()


@dataclass(frozen=True)
class Thresholds:
    standard_pct: float = 92.0        # constitutional standard (Green / meets)
    amber_pct: float = 85.0           # Amber floor
    within_weeks: int = 18            # bands [0, 18) are "within"
    long_wait_weeks: int = 52         # bands [52, ...) are "52+"
    very_long_wait_weeks: int = 104   # open band is "over 104"


THRESHOLDS = Thresholds()

# ---------------------------------------------------------------------------
# Raw extract identity columns, pathway types, labels and
# constants that must equal the published pipeline for identical results.
# ---------------------------------------------------------------------------
RAW_ID_COLUMNS = {
    "Period": "period_raw",
    "Provider Parent Org Code": "provider_parent_org_code",
    "Provider Parent Name": "provider_parent_name",
    "Provider Org Code": "provider_org_code",
    "Provider Org Name": "provider_org_name",
    "Commissioner Parent Org Code": "commissioner_parent_org_code",
    "Commissioner Parent Name": "commissioner_parent_name",
    "Commissioner Org Code": "commissioner_org_code",
    "Commissioner Org Name": "commissioner_org_name",
    "RTT Part Type": "rtt_part_type",
    "RTT Part Description": "rtt_part_description",
    "Treatment Function Code": "treatment_function_code",
    "Treatment Function Name": "treatment_function_name",
}
RAW_TOTAL_COLUMNS = {
    "Total": "total_pathways",
    "Patients with unknown clock start date": "patients_unknown_clock_start",
    "Total All": "total_all",
}
PART_TYPES = ("Part_1A", "Part_1B", "Part_2", "Part_2A", "Part_3")
INCOMPLETE_PART_TYPE = "Part_2"
SUMMARY_SPECIALTY = "C_999"
CORE_SPECIALTIES = ("C_110", "C_130", "C_100", "C_120", "C_999")
NATIONAL_PARENT_CODE = "NATIONAL"
NATIONAL_PARENT_NAME = "National Commissioning"
UNKNOWN_COMMISSIONER_NAME = "Unknown Commissioner"
SOURCE_LABEL = "nhs_england_rtt_statistical_release"
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
PERIOD_PREFIX = "RTT-"
RAG_GREEN, RAG_AMBER, RAG_RED, RAG_UNKNOWN = "Green", "Amber", "Red", "Unknown"
BREACH_LABELS = ("Over 2 Years", "Over 1 Year", "Over 18 Weeks", "Within Standard")
SCORECARD_STATUS = ("Green — Meeting standard", "Amber — Underperforming", "Red — Formal breach")
RAW_COLUMN_COUNT = 121
EXPECTED_PARENT_COUNT = 42
ROW_COUNT_RANGE = (50_000, 300_000)
TOTAL_ALL_RANGE = (0, 500_000)
PROVIDER_UNIQUE_RATIO = (0.001, 0.01)
BAND_SUM_TOLERANCE_PCT = 5.0
PERIOD_REGEX = r"^RTT-[A-Za-z]+[ -][0-9]{4}$"
PROVIDER_CODE_REGEX = r"^[A-Z0-9]{3,6}$"
FRESHNESS_WARN_DAYS, FRESHNESS_ERROR_DAYS = 35, 40
FILE_MIN_BYTES, FILE_MAX_BYTES = 10_000, 50_000_000
FINANCIAL_YEAR_START_MONTH = 4
DEFAULT_RELEASE_FILENAME = "RTT_Full_CSV_{code}.zip"
RELEASE_ANCHOR_TEXT = "Full CSV data file {code}"
PIPELINE_VERSION = "1.0.0"
FACT_LABELS = {"domain": "nhs_rtt", "sensitivity": "official", "refresh": "monthly"}


def raw_columns(bands: BandSpec = BANDS) -> list[str]:
    """The 121 raw extract columns in file order (ids, bands, totals)."""
    return list(RAW_ID_COLUMNS) + bands.raw_names() + list(RAW_TOTAL_COLUMNS)
