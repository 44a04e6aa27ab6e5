"""Fixed values of the listing/sale data model.

The column lists and label sets below must equal the ones of the source
system for the cleaning rules to select the same rows; they are stated
here as plain fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: raw house columns (55) ---------------------------------
ROOM_DIMS = [f"Rm{i}_{part}" for i in range(1, 13) for part in ("len", "wth")]
HOUSE_COLUMNS = ["_id", "Dom", "A_c", "Area_code", "Bath_tot", "Br", "Br_plus", "Bsmt1_out", "Community",
                 "Depth", "Front_ft", "Gar", "Gar_spaces", "Park_spcs", "Gar_type", "Heating", "Kit_plus",
                 "Lp_dol", "Sp_dol", "Lsc", "Pool", "Rms", "Rooms_plus", "S_r", "Style", "Type_own1_out",
                 "Cd", "lat", "lng", "Taxes", "Den_fr"] + ROOM_DIMS

# ---- fixed values: raw condo columns (13) ---------------------------------
CONDO_COLUMNS = ["_id", "Br", "Br_plus", "Lp_dol", "Sp_dol", "Cd", "Apt_num", "Addr", "Bath_tot", "Taxes",
                 "Yr_built", "lat", "lng"]

# ---- fixed values: property-type labels -----------------------------------
HOUSE_LABELS = ["Detached", "Semi-Detached", "Duplex", "Triplex", "Fourplex", "Link", "Att/Row/Twnhouse",
                "Det Condo", "Semi-Det Condo", "Condo Townhouse"]
CONDO_LABELS = ["Condo Apt", "Comm Element Condo", "Co-Ownership Apt", "Co-Op Apt", "Leasehold Condo",
                "Vacant Land Condo", "Condo Apartment", "Phased Condo"]
CONDO_HOUSE_LABELS = ["Condo Townhouse", "Semi-Det Condo", "Det Condo"]

# ---- fixed values: null-fill column sets ----------------------------------
FILL_NONE_COLUMNS = ["A_c", "Pool", "Bsmt1_out", "Gar_type"]
FILL_ZERO_COLUMNS = ["Br_plus", "Kit_plus", "Rooms_plus", "Gar", "Gar_spaces", "Park_spcs"] + ROOM_DIMS + ["Dom"]

# ---- fixed values: flag column names ---------------------------------------
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
AREA_BUCKETS = ["less-than50", "50-to-100", "100-to-150", "150-to-200", "200-to-250", "250-to-350",
                "larger-than350"]
# lower edges of the area buckets above (first is open below)
AREA_EDGES = [50.0, 100.0, 150.0, 200.0, 250.0, 350.0]

# ---- fixed values: thresholds ---------------------------------------------
MIN_PRICE = 50000          # sold/list price must exceed this
COMMUNITY_MIN_COUNT = 12   # communities with more rows than this are kept
OTHER = "Other"

# ---- fixed values: manual condo price rules --------------------------------
MANUAL_RULES = {"373 Front St W:1.0:1.0:1.0": 575000, "560 Front St W:1.0::1.0": 590000,
                "257 Hemlock St:1.0::1.0": 340000}

_DOUBLE_HOUSE = {"Dom", "Bath_tot", "Br", "Br_plus", "Gar", "Gar_spaces", "Park_spcs", "Kit_plus", "Rms",
                 "Rooms_plus", "Depth", "Front_ft", "Lp_dol", "Sp_dol", "Taxes", "lat", "lng"} | set(ROOM_DIMS)


def house_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.DoubleType() if c in _DOUBLE_HOUSE else T.StringType(), True)
                         for c in HOUSE_COLUMNS])


def raw_schema() -> T.StructType:
    """Raw file schema: every house column plus the condo-only ones."""
    fields = list(house_schema().fields)
    for c in CONDO_COLUMNS:
        if c not in HOUSE_COLUMNS:
            fields.append(T.StructField(c, T.StringType(), True))
    return T.StructType(fields)
