"""Country names and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from masterline.functions.text import once, strip
from masterline.functions.wordlists import COUNTRIES


def normalize_country(value: Column, iso: bool = False) -> Column:
    """struct(name, code): by code, then by name, then by the first name that contains the value or is in it.

    Blank is Unknown/XX; anything else unknown is the value in title case and XX. Of two codes with a name
    the later is taken, unless iso asks for the two-letter ones. The value is trimmed once, not once for each country.
    """
    by_name: dict[str, str] = {}
    for code, name in COUNTRIES.items():
        if not (iso and code in ("UK", "USA")):
            by_name[name.upper()] = code
    names = F.create_map(*(F.lit(x) for pair in COUNTRIES.items() for x in pair))
    codes = F.create_map(*(F.lit(x) for pair in by_name.items() for x in pair))
    table = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(c).alias("code"), F.upper(F.lit(n)).alias("upper")) for c, n in COUNTRIES.items()))
    made = lambda name, code: F.struct(name.alias("name"), code.alias("code"))

    def place(v: Column) -> Column:
        code = F.try_element_at(codes, v)
        near = F.get(F.filter(table, lambda x: x["upper"].contains(v) | v.contains(x["upper"])), F.lit(0))
        other = once(near, lambda x: F.when(x.isNotNull(), made(x["name"], x["code"])).otherwise(made(F.initcap(v), F.lit("XX"))))
        return (
            F.when(v == "", made(F.lit("Unknown"), F.lit("XX")))
            .when(F.map_contains_key(names, v), made(F.try_element_at(names, v), v))
            .when(code.isNotNull(), made(F.try_element_at(names, code), code))
            .otherwise(other)
        )

    return once(F.upper(strip(F.coalesce(value, F.lit("")))), place)
