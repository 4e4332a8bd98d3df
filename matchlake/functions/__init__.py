"""Column-level functions (all JVM-side built-ins; no Python UDFs)."""

from .keys import battle_id, list_key, md5_key, xx_key  # noqa: F401
from .dates import (day_name, is_weekend, month_day_year, month_name,  # noqa: F401
                    parse_battle_time, yyyymmdd)
from .arrays import (first_element_fields, flatten_struct, list_avg,  # noqa: F401
                     mirror_cost, slots)
from .text import encode_tag, format_url  # noqa: F401
