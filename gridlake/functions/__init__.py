"""Column-expression helpers. Every function returns a ``Column`` built from
built-in Spark SQL functions only, so everything stays inside whole-stage
codegen and is independent of the session's ANSI setting."""

from gridlake.functions.columns import (  # noqa: F401
    convert,
    first_match,
    global_id,
    global_id_nullsafe,
    lenient_bool,
    lenient_double,
    lenient_int,
    lenient_long,
    lenient_ts,
    map_values,
    null_if_token,
    rating_to_kw,
    typed_null,
)
