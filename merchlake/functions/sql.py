"""The scalar functions under the names that mapping formulas call them by.

They are SQL functions over built-in expressions, which Spark puts into the
query in their place.  Only values that need character references or Unicode normal forms reach
Python, in batches; null stands there for all others.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .parsing import PACKS, TOKENS, UNITS
from .text import FOLD_FROM, FOLD_TO, _clean_values, _key_values, _nfkd

# The functions' names in formulas.
CLEAN, KEY, SIZE_VALUE, SIZE_UNIT = "tr_clean_text", "tr_normalize_key", "tr_size_value", "tr_size_unit"
#: A size of a name: struct(value, unit).
SIZE = "tr_size"

_PLAIN = r"NOT (x RLIKE r'[^\x00-\x7f]|&')"


def _text(python: str, native: str) -> str:
    return f"nullif(CASE WHEN {_PLAIN} THEN {native} ELSE {python}(CASE WHEN NOT ({_PLAIN}) THEN x END) END, '')"


def _size() -> str:
    """``parsing.parse_size`` in SQL."""
    quote = lambda s: "'" + s.replace("'", "\\'") + "'"
    unit, factor = ("map(" + ", ".join(f"{quote(k)}, {quote(v[i]) if i == 0 else f'{v[i]}D'}" for k, v in UNITS.items()) + ")" for i in range(2))
    letters = f"translate(replace(x, 'İ', 'I'), {quote(FOLD_FROM)}, {quote(FOLD_TO)})"
    folded = rf"regexp_replace(coalesce(_merchlake_nfkd(CASE WHEN {letters} RLIKE r'[^\x00-\x7f]' THEN {letters} END), {letters}), r'\p{{M}}', '')"
    after = "CASE WHEN get(w, i + 1) IN ('\\'', '’') THEN get(w, i + 2) ELSE get(w, i + 1) END"
    packs = f"CASE WHEN lower(get(w, i - 1)) IN ({', '.join(map(quote, PACKS))}) THEN try_cast(nullif(regexp_extract(get(w, i - 2), '[0-9]+$', 0), '') AS DOUBLE) END"
    one = f"named_struct('value', round(try_cast(replace(t, ',', '.') AS DOUBLE) * try_element_at({factor}, lower({after})) * coalesce({packs}, 1.0D), 3), 'unit', CASE WHEN t RLIKE '^[0-9]' AND ({after}) <> 'l' THEN try_element_at({unit}, lower({after})) END)"
    words = f"regexp_extract_all({folded}, r'{TOKENS}', 0)"
    found = f"transform(array({words}), w -> filter(transform(w, (t, i) -> {one}), s -> s.unit IS NOT NULL AND s.value > 0))[0]"
    return f"transform(array({found}), f -> coalesce(get(filter(f, s -> s.unit <> 'adet'), 0), get(f, 0)))[0]"


def register(spark: SparkSession) -> None:
    """Make them known to SQL for the session; null in, null out."""
    for name, f in (("_merchlake_clean", _clean_values), ("_merchlake_key", _key_values), ("_merchlake_nfkd", _nfkd)):
        spark.udf.register(name, f)
    bodies = {
        CLEAN: ("STRING", _text("_merchlake_clean", r"trim(regexp_replace(x, r'[\s\x1c-\x1f]+', ' '))")),
        KEY: ("STRING", _text("_merchlake_key", "trim(regexp_replace(lower(x), '[^a-z0-9]+', ' '))")),
        SIZE: ("STRUCT<value: DOUBLE, unit: STRING>", _size()),
        SIZE_VALUE: ("DOUBLE", f"{SIZE}(x).value"),
        SIZE_UNIT: ("STRING", f"{SIZE}(x).unit"),
    }
    for name, (kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {kind} RETURN {body}")
