"""Fixed values shared by the package."""

# Site for the sun's position, degrees north and east.
SITE_LATITUDE = 24.05754867
SITE_LONGITUDE = -104.0226393

# Fixed value: legacy fluxes are divided by this factor.
LEGACY_CORRECTION_FACTOR = 0.7

# Time base and era bounds, UTC.
TIME_BASE = "2000-01-01 12:00:00"
CATALOG_START = "1974-01-01 12:00:00"
GOES_19_START = "2024-09-20 00:00:00"
CATALOG_END_ORDINAL = 76421

# Row statuses and source labels.
STATUS_START = "EVENT_START"
STATUS_PEAK = "EVENT_PEAK"
STATUS_END = "EVENT_END"
MIN_STATUS_ROWS = 3
SOURCES = ["SWPC", "GOES-16", "GOES-19", "JSON"]

# Class letter, limit, multiplier. A flux below limit * 10 gets the letter.
FLUX_CLASSES = [
    ("A", 1e-8, 1e8),
    ("B", 1e-7, 1e7),
    ("C", 1e-6, 1e6),
    ("M", 1e-5, 1e5),
    ("X", 1e-4, 1e4),
]

# Reference levels of the unified series, W/m2.
CLASS_LEVELS = [
    ("x_level", 1e-4),
    ("m5_level", 5e-5),
    ("m_level", 1e-5),
    ("c_level", 1e-6),
]

# Kp step and the Ap it stands for; a step covers values up to step + margin.
KP_AP_STEPS = [
    (0, 0), (0.3, 2), (0.7, 3), (1.0, 4), (1.3, 5), (1.7, 6), (2.0, 7),
    (2.3, 9), (2.7, 12), (3.0, 15), (3.3, 18), (3.7, 22), (4.0, 27), (4.3, 32),
    (4.7, 39), (5.0, 48), (5.3, 56), (5.7, 67), (6.0, 80), (6.3, 94), (6.7, 111),
    (7.0, 132), (7.3, 154), (7.7, 179), (8.0, 207), (8.3, 236), (8.7, 300), (9.0, 400),
]
KP_STEP_MARGIN = 0.15
KP_AP_DEFAULT = 400

# Page bounds of the read queries.
DEFAULT_PAGE_SIZE = 100
MAX_PAGE_SIZE = 1000

# Poll period and file names of the feeds.
POLL_SECONDS = 300
LATEST_EVENT_FILE = "xray-flares-latest.json"
ARRAY_FILE_PREFIX = "sci_xrsf-l2-flsum_g19"
ARRAY_FILE_SUFFIX = ".nc"

# The periodic terms of the sun's longitude by P. Bretagnon and J.-L. Simon,
# Planetary Programs and Tables from -4000 to +2800 (1986): size in 1e-7 radians, phase in
# degrees, and degrees per Julian century.
SUN_TERMS = (
    (403406, 270.54861, 0.9287892), (195207, 340.19128, 35999.1376958), (119433, 63.91854, 35999.4089666),
    (112392, 331.2622, 35998.7287385), (3891, 317.843, 71998.20261), (2819, 86.631, 71998.4403),
    (1721, 240.052, 36000.35726), (660, 310.26, 71997.4812), (350, 247.23, 32964.4678),
    (334, 260.87, -19.441), (314, 297.82, 445267.1117), (268, 343.14, 45036.884),
    (242, 166.79, 3.1008), (234, 81.53, 22518.4434), (158, 3.5, -19.9739),
    (132, 132.75, 65928.9345), (129, 182.95, 9038.0293), (114, 162.03, 3034.7684),
    (99, 29.8, 33718.148), (93, 266.4, 3034.448), (86, 249.2, -2280.773),
    (78, 157.6, 29929.992), (72, 257.8, 31556.493), (68, 185.1, 149.588),
    (64, 69.9, 9037.75), (46, 8.0, 107997.405), (38, 197.1, -4444.176),
    (37, 250.4, 151.771), (32, 65.3, 67555.316), (29, 162.7, 31556.08),
    (28, 341.5, -4561.54), (27, 291.6, 107996.706), (27, 98.5, 1221.655),
    (25, 146.7, 62894.167), (24, 110.0, 31437.369), (21, 5.2, 14578.298),
    (21, 342.6, -31931.757), (20, 230.9, 34777.243), (18, 256.1, 1221.999),
    (17, 45.3, 62894.511), (14, 242.9, -4442.039), (13, 115.2, 107997.909),
    (13, 151.8, 119.066), (13, 285.3, 16859.071), (12, 53.3, -4.578),
    (10, 126.6, 26895.292), (10, 205.7, -39.127), (10, 85.9, 12297.536),
    (10, 146.1, 90073.778),
)
