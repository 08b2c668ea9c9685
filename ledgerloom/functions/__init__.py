"""Column expressions: keys, null-safe arithmetic, geography, web, dates, names."""

from ledgerloom.functions.arithmetic import safe_add, safe_divide, safe_subtract, width_bucket
from ledgerloom.functions.casts import as_double, as_integer
from ledgerloom.functions.dates import add_interval, boundaries_between
from ledgerloom.functions.geo import haversine_distance
from ledgerloom.functions.keys import surrogate_key
from ledgerloom.functions.names import slug, slugify
from ledgerloom.functions.web import url_host, url_parameter, url_path

__all__ = [
    "add_interval",
    "as_double",
    "as_integer",
    "boundaries_between",
    "haversine_distance",
    "safe_add",
    "safe_divide",
    "safe_subtract",
    "slug",
    "slugify",
    "surrogate_key",
    "url_host",
    "url_parameter",
    "url_path",
    "width_bucket",
]
