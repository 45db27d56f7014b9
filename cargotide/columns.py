"""Default column names of the data model (all of them are parameters of the operators)."""

DATE = "ACTUALSHIPDATE"
WAREHOUSE = "WHSEID"
SKU = "SKU"
CATEGORY = "CATEGORY"
BRAND = "BRAND"
LINE_QTY = "QTY"
LINE_CBM = "CUBE_OUT"
QTY = "Total QTY"
CBM = "Total CBM"

PANEL_KEYS = (WAREHOUSE, CATEGORY, BRAND)
SERIES_KEYS = (CATEGORY,)
