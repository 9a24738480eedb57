"""Scalars over JSON, maps, vectors and the text of player profiles."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import ship


def _canonical(value: str | None) -> str | None:
    return None if value is None else json.dumps(json.loads(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def canonical_json(value: Column) -> Column:
    """JSON with sorted keys and no blanks; NULL stays, broken JSON is an error."""
    ship()

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(_canonical, na_action="ignore")

    return run(value)


def json_digest(value: Column) -> Column:
    return F.sha2(canonical_json(value), 256)


def _differences(a, b, path: str = "$") -> list[dict]:
    if isinstance(a, dict) and isinstance(b, dict):
        return [d for k in sorted(a.keys() | b.keys()) for d in _differences(a.get(k, _differences), b.get(k, _differences), f"{path}.{k}")]
    if isinstance(a, list) and isinstance(b, list):
        at = lambda x, i: x[i] if i < len(x) else _differences
        return [d for i in range(max(len(a), len(b))) for d in _differences(at(a, i), at(b, i), f"{path}[{i}]")]
    if type(a) is type(b) and a == b or (isinstance(a, (int, float)) and isinstance(b, (int, float)) and a == b):
        return []
    shown = lambda x: "<missing>" if x is _differences else json.dumps(x, ensure_ascii=False, sort_keys=True)
    return [{"path": path, "expected": shown(a), "actual": shown(b)}]


def json_differences(expected: Column, actual: Column) -> Column:
    """Array of (path, expected, actual) where two JSON texts differ, '<missing>' for what one lacks; NULL reads as null."""
    ship()

    @F.pandas_udf("array<struct<path:string,expected:string,actual:string>>")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        read = lambda x: None if x is None else json.loads(x)
        return pd.Series([_differences(read(x), read(y)) for x, y in zip(a, b)])

    return run(expected, actual)


def merge_maps(old: Column, new: Column) -> Column:
    """Both maps; a key of both has the new value."""
    kept = F.map_filter(F.coalesce(old, F.create_map().cast("map<string,string>")), lambda k, v: ~F.array_contains(F.map_keys(F.coalesce(new, F.create_map().cast("map<string,string>"))), k))
    return F.map_concat(kept, F.coalesce(new, F.create_map().cast("map<string,string>")))


def unit_vector(vector: Column, size: int) -> Column:
    """The vector cut or filled with zeros to ``size`` and divided by its length; zeros stay zeros."""
    v = F.slice(F.concat(F.transform(vector, lambda x: x.cast("double")), F.array_repeat(F.lit(0.0), size)), 1, size)
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(length > 0, F.transform(v, lambda x: x / length)).otherwise(v)


def path_number(value: Column, path: str) -> Column:
    """The number at a dotted path; NULL for anything that is no JSON number."""
    raw = F.get_json_object(value, f"$.{path}")
    return F.when(F.regexp_like(raw, F.lit(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$")), raw.try_cast("double"))


# Hands by the sign in '(우투좌타)'.
HANDS = [("우", "R"), ("좌", "L"), ("양", "S")]


def height_weight(text: Column) -> Column:
    """struct(height_cm, weight_kg) of '180cm/95kg'."""
    at = lambda i: F.regexp_extract(text, r"(?i)([0-9]+)\s*cm\s*/\s*([0-9]+)\s*kg", i).try_cast("int")
    return F.struct(at(1).alias("height_cm"), at(2).alias("weight_kg"))


def hands(text: Column) -> Column:
    """struct(throws, bats) of '포수(우투좌타)' as R, L and S."""

    def side(i):
        sign, out = F.regexp_extract(text, r"\((.?)\s*투(.?)\s*타\)", i), F.lit(None).cast("string")
        for k, v in HANDS:
            out = F.when(sign == k, v).otherwise(out)
        return out

    return F.struct(side(1).alias("throws"), side(2).alias("bats"))


def birth_date(text: Column) -> Column:
    """yyyy-MM-dd of the long form, or of digits with - . / between."""
    long, short = r"([0-9]{4})\s*년\s*([0-9]{1,2})\s*월\s*([0-9]{1,2})\s*일", r"([0-9]{4})[-./]([0-9]{1,2})[-./]([0-9]{1,2})"
    form = lambda p: F.when(text.rlike(p), F.concat(F.regexp_extract(text, p, 1), *[x for i in (2, 3) for x in (F.lit("-"), F.lpad(F.regexp_extract(text, p, i), 2, "0"))]))
    return F.coalesce(form(long), form(short))


def money(text: Column) -> Column:
    """struct(amount, currency): digits, times 10,000 for 만원; USD by its signs, else KRW; NULL without digits."""
    t = F.trim(text)
    n = F.when(~t.isin("-", "", "None", "NULL"), F.regexp_replace(t, "[^0-9]", "").try_cast("long"))
    usd = t.contains("달러") | t.contains("USD") | t.contains("$")
    amount = F.when(~usd & t.contains("만원"), n * 10000).otherwise(n)
    return F.struct(amount.alias("amount"), F.when(n.isNotNull(), F.when(usd, "USD").otherwise("KRW")).alias("currency"))


def snippet(text: Column, word: str, around: int = 40) -> Column:
    """The text around the first ``word``, whatever its case, with every one of them between **."""
    at = F.instr(F.lower(text), word.lower())
    cut = F.when(at > 0, F.substr(text, F.greatest(F.lit(1), at - around), F.lit(2 * around + len(word)))).otherwise(F.substring(text, 1, 2 * around))
    literal = "".join(f"\\{c}" if not c.isalnum() and not c.isspace() else c for c in word)
    return F.regexp_replace(cut, f"(?i){literal}", f"**{word}**")
