"""Fixed values shared by every stage.

These values must stay exactly as written for results to agree with the
original pipeline's output: the app-code lists, category names, segment labels
and thresholds are part of the data contract, not tuning knobs.
"""

from __future__ import annotations

# --- fixed values: app code -> content category (case-sensitive) -------------
TRUYEN_HINH_CODES = ("CHANNEL", "DSHD", "KPLUS", "KPlus")
PHIM_TRUYEN_CODES = ("VOD", "FIMS_RES", "BHD_RES", "VOD_RES", "FIMS", "BHD", "DANET")
GIAI_TRI_CODES = ("RELAX",)
THIEU_NHI_CODES = ("CHILD",)
THE_THAO_CODES = ("SPORT",)

# Mapping in the order the rules are tested; anything else (and NULL) is Error.
CATEGORY_RULES = (
    ("Truyen_Hinh", TRUYEN_HINH_CODES),
    ("Phim_Truyen", PHIM_TRUYEN_CODES),
    ("Giai_Tri", GIAI_TRI_CODES),
    ("Thieu_Nhi", THIEU_NHI_CODES),
    ("The_Thao", THE_THAO_CODES),
)
ERROR_CATEGORY = "Error"

# Content categories in table column order (alphabetical, as a pivot lays them
# out). Ties in MostWatch and the order of names in Taste follow this order.
CATEGORIES = ("Giai_Tri", "Phim_Truyen", "The_Thao", "Thieu_Nhi", "Truyen_Hinh")
# Pivot output columns: every category plus Error, sorted by name.
PIVOT_COLUMNS = tuple(sorted(CATEGORIES + (ERROR_CATEGORY,)))

# Activity segment: more than ACTIVE_MIN_DAYS distinct days -> High, else Low.
ACTIVE_MIN_DAYS = 4
ACTIVE_HIGH = "High"
ACTIVE_LOW = "Low"

# Contract value of the anomalous null bucket, removed before serving views.
NULL_BUCKET_CONTRACT = "0"

# Taste separator.
TASTE_SEPARATOR = "-"
# --- end of fixed values -------------------------------------------------------

# Column names of the layers.
CONTRACT = "Contract"
MAC = "Mac"
DURATION = "TotalDuration"
APP = "AppName"
TYPE = "Type"
EXEC_DATE = "execution_date"
EXEC_DAY = "execution_day"
SOURCE_FILE = "source_file"
TOTAL_DEVICES = "TotalDevices"
DISTINCT_DEVICES = "DistinctDevices"
MOST_WATCH = "MostWatch"
TASTE = "Taste"
ACTIVE = "Active"
ACTIVE_DAYS = "active_days"
ROW_INDEX = "row_index"
BATCH_ID = "batch_id"

# Key of the serving table.
SERVING_KEY = (CONTRACT, EXEC_DAY, SOURCE_FILE)
