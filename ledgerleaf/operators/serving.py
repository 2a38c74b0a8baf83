"""Post-processing of model output: JSON salvage, document gate, field counts."""

from __future__ import annotations

import contextlib
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the document menu
DOC_TYPES = ("hcfa_1500", "ub04", "eob", "medical_record", "cover_sheet", "id_card", "correspondence", "other")


_DECODER = json.JSONDecoder()
_BLANK = re.compile(r"[ \t\n\r]*")
#: What separates a pair from the next, or ends the object.
_NEXT = re.compile(r"[ \t\n\r]*([,}])")


class _Pairs:
    """Scans an object pair by pair from its brace; what is whole so far is kept when the text breaks off."""

    def __init__(self, text: str, brace: int):
        self.text, self.at, self.pairs, self.sure, self.closed = text, brace + 1, [], 0, False
        with contextlib.suppress(ValueError):
            self._scan()

    def _value(self):
        value, self.at = _DECODER.raw_decode(self.text, _BLANK.match(self.text, self.at).end())
        return value

    def _sign(self, wanted: re.Pattern) -> str:
        found = wanted.match(self.text, self.at)
        if not found:
            raise ValueError("another sign was expected")
        self.at = found.end()
        return found.group(1)

    def _scan(self) -> None:
        if empty := re.compile(r"[ \t\n\r]*}").match(self.text, self.at):
            self.at, self.closed = empty.end(), True
        while not self.closed:
            key = self._value()
            if not isinstance(key, str):
                raise ValueError("a key is a string")
            self._sign(re.compile(r"[ \t\n\r]*(:)"))
            value = self._value()
            quoted, end = isinstance(value, str), self.at
            self.closed = self._sign(_NEXT) == "}"
            self.pairs.append((key, value))
            if quoted and not self.closed and self.at == end + 1:
                self.sure = len(self.pairs)


def _salvage(t: str | None) -> dict | None:
    """The first object of a text; of one that breaks off, or that more text follows, the pairs up to the last text with a comma behind it.

    White space may follow the object, and the ticks of a fence if the text began with one.
    """
    brace = (t or "").find("{")
    if brace < 0:
        return None
    found = _Pairs(t, brace)
    rest = t[found.at :].strip("` \t\r\n" if t.lstrip().startswith("```") else None)
    if found.closed and not rest:
        return dict(found.pairs)
    return dict(found.pairs[: found.sure]) if found.sure else None


@F.pandas_udf(T.StringType())
def extract_json(texts: pd.Series) -> pd.Series:
    """Compact JSON found in each text, NULL if there is none."""

    def one(t):
        got = _salvage(t)
        return None if got is None else json.dumps(got, ensure_ascii=False, separators=(",", ":"))

    return texts.map(one)


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def json_fields(texts: pd.Series) -> pd.Series:
    """Fields of a strict JSON object as texts: numbers as written by Python, true as True, null as blank."""

    def one(t):
        try:
            got = json.loads(t)
        except (TypeError, ValueError):
            return None
        return {k: "" if v is None else str(v) for k, v in got.items()} if isinstance(got, dict) else None

    return texts.map(one)


def _word(raw: Column) -> Column:
    return F.lower(F.trim(F.coalesce(raw.cast("string"), F.lit(""))))


def doc_type(raw: Column) -> Column:
    """A type of the menu, or 'unknown'."""
    return F.when(_word(raw).isin(*DOC_TYPES), _word(raw)).otherwise("unknown")


def confidence(raw: Column) -> Column:
    return F.when(_word(raw).isin("high", "medium", "low"), _word(raw)).otherwise("low")


def classified(answer: Column) -> Column:
    """struct(doc_type, confidence) of a classifier's answer; an answer without JSON is unknown, low."""
    found = extract_json(answer)
    return F.struct(
        doc_type(F.get_json_object(found, "$.doc_type")).alias("doc_type"),
        confidence(F.get_json_object(found, "$.confidence")).alias("confidence"),
    )


def bill_gate(raw_type: Column, raw_confidence: Column, force: Column) -> Column:
    """Whether a page is extracted as a bill."""
    return F.coalesce(force, F.lit(False)) | doc_type(raw_type).isin("hcfa_1500", "unknown") | (confidence(raw_confidence) == "low")


def num_fields(fields: Column) -> Column:
    return F.coalesce(F.size(F.map_filter(fields, lambda k, v: F.coalesce(v, F.lit("")) != "")), F.lit(0))
