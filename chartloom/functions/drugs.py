"""Decoding of drug code lists."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.columns import ColumnOrName, as_column

# The drug dictionary of the source data, code -> name.
DRUG_NAMES = {
    "625": "STAVUDINE",
    "628": "LAMIVUDINE",
    "630": "ZIDOVUDINE AND LAMIVUDINE",
    "631": "NEVIRAPINE",
    "633": "EFAVIRENZ",
    "635": "NELFINAVIR",
    "749": "INDINAVIR",
    "791": "EMTRICITABINE",
    "792": "STAVUDINE LAMIVUDINE AND NEVIRAPINE",
    "794": "LOPINAVIR AND RITONAVIR",
    "795": "RITONAVIR",
    "796": "DIDANOSINE",
    "797": "ZIDOVUDINE",
    "802": "TENOFOVIR",
    "814": "ABACAVIR",
    "817": "ABACAVIR LAMIVUDINE AND ZIDOVUDINE",
    "1065": "YES",
    "1066": "NO",
    "1107": "NONE",
    "1400": "LAMIVUDINE AND TENOFOVIR",
    "5424": "OTHER ANTIRETROVIRAL DRUG",
    "5811": "UNKNOWN ANTIRETROVIRAL DRUG",
    "6156": "RALTEGRAVIR",
    "6157": "DARUNAVIR",
    "6158": "ETRAVIRINE",
    "6159": "ATAZANAVIR",
    "6160": "ATAZANAVIR AND RITONAVIR",
    "6180": "EMTRICITABINE AND TENOFOVIR",
    "6467": "NEVIRAPINE LAMIVUDINE AND ZIDOVUDINE",
    "6679": "ABACAVIR AND LAMIVUDINE",
    "6964": "TENOFOVIR AND LAMIVUDINE AND EFAVIRENZ",
    "6965": "LAMIVUDINE AND STAVUDINE",
    "9026": "LOPINAVIR",
    "9435": "EVIPLERA",
    "9759": "DOLUTEGRAVIR",
}

LIST_SEPARATOR = " ## "


def code_map(mapping: dict[str, str]) -> Column:
    """A dictionary as a map literal."""
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])


def split_ids(column: ColumnOrName, sep: str = LIST_SEPARATOR) -> Column:
    """Split an id list; NULL stays NULL."""
    return F.split(as_column(column), sep)


def map_codes(ids: ColumnOrName, mapping: dict[str, str] | None = None, trailing: bool = True) -> Column:
    """Names of an array of codes as one text; unknown codes are left out, NULL stays NULL.

    With ``trailing`` every name is followed by a comma, the last one too.
    """
    array = as_column(ids)
    lookup = code_map(DRUG_NAMES if mapping is None else mapping)
    names = F.filter(
        F.transform(array, lambda code: F.try_element_at(lookup, code)), lambda name: name.isNotNull()
    )
    text = F.array_join(names, ",")
    if trailing:
        text = F.when(F.size(names) > 0, F.concat(text, F.lit(","))).otherwise(text)
    return F.when(array.isNotNull(), text)


def drug_names(column: ColumnOrName) -> Column:
    """Names for a separated list of drug codes."""
    return map_codes(split_ids(column))
