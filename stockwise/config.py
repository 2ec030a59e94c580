"""Run-wide parameters.

Every operator takes an explicit ``as_of`` date instead of the wall clock so
results are reproducible and comparable with the SQL oracles. The defaults
below fit the driver's tables (orders 1995-01-01 .. 2001-08-01).
"""

import datetime as _dt

AS_OF = _dt.date(2001, 8, 15)
PLAN_YEAR = 2001
PLAN_MONTH = 9

# Fixed business values of the reference (kept verbatim).
QUOTATION_CHANNEL = "Cotizaciones"
RAW_MATERIAL_PATTERNS = ("%MP%", "%MATERIA PRIMA%", "%RAW MATERIAL%")
VAT_RATE_DIVISOR = 1.19
PRIORITY_ORDER = ("CRITICO", "ALTA", "MEDIA", "BAJA")
ROTATION_THRESHOLD = 50
INVALID_SKU_TOKENS = ("false", "true", "none", "nan", "null")
SEARCH_K = 20
SEARCH_THRESHOLD = 0.8
