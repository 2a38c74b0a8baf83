"""Cross-field rules over claims, as boolean Columns (NULL input: rule broken)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ok(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def total_matches(lines: Column, charge: str, total: Column) -> Column:
    """The lines' charges sum to the total, in decimals."""
    summed = F.aggregate(lines, F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + x[charge].try_cast("decimal(18,2)")).cast("decimal(38,2)"))
    return _ok(summed == total.try_cast("decimal(18,2)"))


def pointers_valid(pointers: Column, diagnoses: Column) -> Column:
    """Every letter A to L points at a diagnosis that is there."""
    letters = F.filter(F.split(pointers, ""), lambda x: x != "")
    return _ok((F.size(letters) > 0) & F.forall(letters, lambda x: x.rlike("^[A-L]$") & (F.ascii(x) - 64 <= F.size(diagnoses))))


def pointed_codes(pointers: Column, diagnoses: Column) -> Column:
    return F.transform(F.filter(F.split(pointers, ""), lambda x: x.rlike("^[A-L]$")), lambda x: F.get(diagnoses, F.ascii(x) - 65))


def tax_id_valid(tax_id: Column, kind: Column) -> Column:
    """EIN 12-3456789, SSN 123-45-6789."""
    return _ok(F.when(kind == "EIN", tax_id.rlike(r"^[0-9]{2}-[0-9]{7}$")).when(kind == "SSN", tax_id.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")))


def dates_in_order(birth: Column, service: Column, as_of: Column) -> Column:
    return _ok((birth < service) & (service <= as_of))


def self_mirrored(relationship: Column, patient: Column, insured: Column) -> Column:
    """A patient who is the insured has the insured's data."""
    return _ok((relationship != "self") | patient.eqNullSafe(insured))
