"""Station and path names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Two station names that follow no naming rule, and their hub.
IRREGULAR_HUBS = {
    "FSATH- สาทร": "HSATH",
    "DJOMT-B-จอมทอง": "HJOMT-B",
}


def part_before(text: Column, delimiter: str) -> Column:
    return F.split_part(text, F.lit(delimiter), F.lit(1))


def station_code(name: Column) -> Column:
    """'HABCD-A - Place' -> 'HABCD-A'."""
    return part_before(name, " -")


def first_list_item(text: Column) -> Column:
    """First element of '[a,b,c]' held as text; only the opening bracket is dropped."""
    return F.trim(F.replace(part_before(text, ","), F.lit("["), F.lit("")))


def last_list_item(text: Column) -> Column:
    """Last element of '[a,b,c]' held as text; only the closing bracket is dropped."""
    last = F.element_at(F.split(text, ","), -1)
    return F.trim(F.replace(last, F.lit("]"), F.lit("")))


def district_code(hub: Column) -> Column:
    """The four letters after the type letter: 'HABCD-A' -> 'ABCD'."""
    return F.substring(part_before(hub, "-"), 2, 4)


def _irregular(name: Column) -> Column:
    chain = F.lit(None).cast("string")
    for station, hub in IRREGULAR_HUBS.items():
        chain = F.when(name == station, hub).otherwise(chain)
    return chain


def delivery_hub(name: Column) -> Column:
    """Code of a delivery hub, irregular names resolved."""
    return F.coalesce(_irregular(name), station_code(name))


def delivery_hub_of_any(name: Column) -> Column:
    """Like `delivery_hub`, and a first-mile (F) or drop-off (D) station counts as the
    delivery hub (H) with the same code."""
    code = station_code(name)
    tail = F.substr(code, F.lit(2))
    sibling = F.when(name.startswith("F") | name.startswith("D"), F.concat(F.lit("H"), tail))
    return F.coalesce(_irregular(name), sibling, code)
