"""Column operators used by the stage models. All run inside codegen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys and masks must equal those of existing tables.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
EMAIL_MASK = "*****"
SSN_MASK = "xxx-xx-"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """Lower-case MD5 hex over the parts as text.

    A NULL part counts as a fixed placeholder. Parts that contain the separator can
    collide: ("a-b", "c") and ("a", "b-c") have the same key.
    """
    if not parts:
        raise ValueError("a key needs at least one part")
    texts = [F.coalesce(_column(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts).cast("binary"))


def mask_email(email: Column | str) -> Column:
    """First character, five stars, then everything from the first `@`.

    Without an `@` nothing follows the stars. The mask is lossy: never join on it.
    """
    c = _column(email)
    at = F.instr(c, "@")
    domain = F.when(at > 0, c.substr(at, F.length(c))).otherwise(F.lit(""))
    return F.concat(F.substring(c, 1, 1), F.lit(EMAIL_MASK), domain)


def mask_ssn(ssn: Column | str) -> Column:
    """Keep only the last group of a `123-45-6789` number."""
    return F.concat(F.lit(SSN_MASK), F.substring(_column(ssn), 8, 4))


def gen_id(seed: int | None = None) -> Column:
    """Uniform integer from 1 to 10000. Not unique, and not stable between runs."""
    return (F.floor(F.rand(seed) * 10000) + 1).cast("int")


def full_name(first: Column | str, last: Column | str) -> Column:
    """Both names with a space between; NULL when either is NULL."""
    return F.concat(_column(first), F.lit(" "), _column(last))


def load_stamp(run_ts: str | Column | None = None) -> Column:
    """The load time of a run: the query's start, or a given time."""
    if run_ts is None:
        return F.current_timestamp()
    return (F.lit(run_ts) if isinstance(run_ts, str) else run_ts).cast("timestamp")


def first_where(array: Column | str, predicate: Callable[[Column], Column]) -> Column:
    """First element for which the predicate is true, else NULL."""
    return F.get(F.filter(_column(array), predicate), F.lit(0))


def first_element(array: Column | str) -> Column:
    """First element, or NULL for an empty or NULL array."""
    return F.get(_column(array), F.lit(0))
