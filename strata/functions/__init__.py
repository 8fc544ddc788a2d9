"""Column -> Column helpers (JVM-side expressions only, no Python UDFs)."""

from strata.functions.columns import (  # noqa: F401
    first_tax_id,
    m2o_id,
    m2o_name,
    tax_amount,
    text_default,
    to_double,
    truthy,
)
from strata.functions.dates import (  # noqa: F401
    floor_to_second,
    parse_naive_utc,
    utc_to_local_date,
)
from strata.functions.tabular import normalize_tabular, strip_leading_quote  # noqa: F401
