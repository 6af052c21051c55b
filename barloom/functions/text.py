"""Text rules on names, tickers, numbers and markup, as column expressions."""
import html
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from barloom import contracts as K

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _words(words) -> str:
    return "(?i)" + "|".join(r"\b" + w + r"\b" for w in words)


def is_spac(name: Column) -> Column:
    shares = _words(K.SPAC_SHARE_WORDS)
    return name.rlike(_words([K.SPAC_WORD])) | (
        name.rlike(_words([K.ACQUISITION_WORD])) & name.rlike(shares))


def is_non_common(name: Column) -> Column:
    return name.rlike(_words(K.NON_COMMON_WORDS))


def listing_exclusion(name: Column) -> Column:
    """Exclusion code used by the listing refresh: share type is looked at first."""
    return F.when(is_non_common(name), "EXCLUDED_NON_COMMON").when(is_spac(name), "EXCLUDED_SPAC")


def closing_exclusion(name: Column) -> Column:
    """Exclusion code used when a quarantine is closed: SPAC is looked at first."""
    return F.when(is_spac(name), "EXCLUDED_SPAC").when(is_non_common(name), "EXCLUDED_NON_COMMON")


def exchange_code(value: Column) -> Column:
    return F.translate(F.upper(value), " -", "__")


def us_ticker_key(ticker: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(ticker)), "[./-]", "")


def hk_ticker_key(ticker: Column) -> Column:
    code = F.regexp_extract(F.upper(ticker), r"(?<!\d)(\d{1,5})(?:\.HK)?\b", 1)
    return F.when(code != "", F.lpad(code, 5, "0"))


def hk_ticker(code: Column) -> Column:
    return F.concat(F.format_string("%04d", code.cast("long")), F.lit(".HK"))


def parse_number(text: Column) -> Column:
    """Provider number text: `$1,234.5`, `12%`, `(3.2)` is negative, blanks and N/A are null."""
    bare = F.translate(F.trim(text), "$,%", "")
    signed = F.regexp_replace(bare, r"^\((.*)\)$", "-$1")
    return F.when(~bare.isin("", "N/A", "--", "-"), signed.try_cast("double"))


@arrow_udf(T.StringType())
def unescape(text: pa.Array) -> pa.Array:
    """HTML entities to characters; the full named list lives in the standard library."""
    return pa.array([None if t is None else html.unescape(t) for t in text.to_pylist()], pa.string())


def _one_blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, "\u00a0", " "), r"\s+", " "))


def cell_text(markup: Column) -> Column:
    """Text of a table cell: tags removed, then entities decoded, so that escaped signs stay; one blank for white space."""
    return _one_blank(unescape(F.regexp_replace(markup, "<[^>]+>", "")))


def strip_markup(markup: Column) -> Column:
    """Text of a designated list: entities decoded first, then tags removed; one blank for white space."""
    return _one_blank(F.regexp_replace(unescape(markup), "<[^>]+>", ""))


def parse_day(text: Column) -> Column:
    """dd/MM/yyyy, null when it is not a date."""
    return F.to_date(F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))


def is_results_meeting(purpose: Column) -> Column:
    return F.upper(purpose).rlike("|".join(K.RESULT_PHRASES))
