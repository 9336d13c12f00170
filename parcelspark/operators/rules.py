"""Ordered first-match rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from parcelspark import fixed_values as V

Rule = tuple[Column, object]


def apply_rules(rules: Sequence[Rule], default: object = None) -> Column:
    """The value of the first rule whose condition is true. A NULL condition does not match."""
    (condition, value), *rest = rules
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def starts_with_any(text: Column, *prefixes: str) -> Column:
    found = text.startswith(prefixes[0])
    for p in prefixes[1:]:
        found = found | text.startswith(p)
    return found


def responsible_team(status: Column, station: Column, is_dropoff: Column) -> Column:
    """Team that answers for a loss, from the event before it. The order decides: the broad
    first-mile, last-mile and exception prefixes come before the single line-haul statuses. The
    underscore in the return prefixes is LIKE's wildcard: any one character fits."""
    at_sort_centre = station.isin(*V.SORT_CENTRE_NAMES)
    return apply_rules(
        [
            (status.startswith("3PL"), "4PL"),
            (starts_with_any(status, "SP", "DOP") | (status == "Auto_to_Pending_Drop_off"), "SP"),
            (
                starts_with_any(status, "FM", "LM", "Exc") | status.like("Return_FM%") | status.like("Return_LM%")
                | status.isin("Delivering", "Onhold", "SOC_Pickup_Done"),
                "CTO",
            ),
            ((status.startswith("SOC") | status.like("Return_SOC%")) & at_sort_centre, "MM"),
            ((status == "Reallocate") & at_sort_centre, "MM"),
            (status == "Created", "MM"),
            (status.isin("Return_SOC_LHTransporting", "Return_SOC_LHTransported"), "CTO/MM"),
            (
                status.isin(
                    "SOC_Pickup_Onhold", "SOC_Pickup_Failed", "Transporting_to_sp", "Transported_to_sp"
                ),
                "SP/CTO",
            ),
            (
                status.isin("SOC_Received", "SOC_Packing", "SOC_Packed", "SOC_Handover", "Reallocate"),
                "CTO",
            ),
            ((status == "SOC_Pickup_Handedover") & is_dropoff, "SP/CTO"),
            ((status == "SOC_Pickup_Handedover") & ~is_dropoff, "CTO/MM"),
        ]
    )


def flow_by_first_word(status_name: Column) -> Column:
    is_return = F.split_part(status_name, F.lit("_"), F.lit(1)) == "Return"
    return F.when(is_return, "Return").otherwise("Forward")


def flow_by_mention(status_name: Column) -> Column:
    return F.when(status_name.contains("Return"), "RTN").otherwise("FWD")


def type_by_flags_open() -> Column:
    """Order type for open shipments; a marketplace flag outranks bulky and open service."""
    return apply_rules(
        [
            (F.col("is_warehouse"), "WH"),
            (F.col("is_cross_border"), "CB"),
            (F.col("is_marketplace"), "MKP"),
            (F.col("is_bulky"), "BKY"),
            (F.col("is_open_service"), "NS"),
        ],
        "MKP",
    )


def type_by_flags_contact() -> Column:
    """Order type on the contact sheet; open service outranks bulky and has another label."""
    return apply_rules(
        [
            (F.col("is_warehouse"), "WH"),
            (F.col("is_cross_border"), "CB"),
            (F.col("is_open_service"), "OSV"),
            (F.col("is_bulky"), "BKY"),
        ],
        "MKP",
    )


def type_by_code(code: Column) -> Column:
    return apply_rules(
        [
            (code == "0", "WH"),
            (code == "1", "CB"),
            (code == "12", "NS"),
            (code.isin("2", "6", "9", "14", "15"), "MKP"),
            (code.isin("7", "8"), "BKY"),
        ]
    )


def type_by_name(name: Column, names: dict[str, str]) -> Column:
    return apply_rules([(name == full, short) for full, short in names.items()], "MKP")


def return_type(order_type: Column, region: Column) -> Column:
    return apply_rules([(order_type.isin(0, 1), "SCOM"), (region == "GBKK", "GBKK")], "UPC")


def operator_group(operator: Column) -> Column:
    # Prefixes of machine operators.
    machines = ("IND", "CAB", "DWS", "MQB")
    return apply_rules([(operator.startswith(m), f"{m}000001") for m in machines], "return_agent")


def station_function(station: Column, brand_prefix: str, more_sort_centre: Column | None = None) -> list[Rule]:
    """Which function works at a station, by its name."""
    sort_centre = station.startswith("SOC")
    if more_sort_centre is not None:
        sort_centre = sort_centre | more_sort_centre
    return [
        (station.startswith("H"), "LM"),
        (station.startswith("F"), "FM"),
        (station.startswith("D"), "SDOP"),
        (station.startswith("Partner"), "PS"),
        (sort_centre, "SOC"),
        (station.isin(*V.REGIONAL), "RC"),
        (station.startswith(brand_prefix), "PS"),
    ]


def stations_of_leg(
    status: Column, next_status: Column, hub: Column, next_station: Column, named_station: Column
) -> dict[str, Column]:
    """Three readings of the station that a stretch between two events counts for: where a
    departure without arrival leads to, where an arrival leads to, and the hub itself or,
    without one, the station named in the event text. `_on_road` marks departure to arrival.

    To be computed in a projection of their own: each is tested by many rules, and nested into
    them the generated code would grow too large to be compiled.
    """
    leaves, arrives = status.isin(*V.LEADTIME_DEPARTED), status.isin(*V.LEADTIME_ARRIVED)
    arrives_next = next_status.isin(*V.LEADTIME_ARRIVED)
    return {
        "_after_departure": F.when(leaves & ~arrives_next, next_station).otherwise(hub),
        "_after_arrival": F.when(arrives, next_station).otherwise(hub),
        "_own": F.coalesce(hub, named_station),
        "_on_road": leaves & arrives_next,
    }


def function_of_leg(partner: Column, brand_prefix: str) -> Column:
    """Function that a stretch counts for: the readings of `stations_of_leg` are tried in turn."""
    own = F.col("_own")
    own_is_sort_centre = own == "Sorting center"
    return apply_rules(
        [
            (partner.isin(*V.PARTNER_CARRIERS), "4PL"),
            (F.col("_on_road"), "LH"),
            *station_function(F.col("_after_departure"), brand_prefix),
            *station_function(F.col("_after_arrival"), brand_prefix, own_is_sort_centre),
            *station_function(own, brand_prefix, own_is_sort_centre),
        ]
    )


def destination_zone(flow: Column, order_type: Column, hub: Column, region: Column) -> Column:
    return apply_rules(
        [
            ((flow == "Return") & order_type.isin("CB", "WH"), "GBKK"),
            (hub.isin(*V.REGIONAL), "4PL"),
            (hub.isin(*V.ZONE_CENTRAL_HUBS), "GBKK"),
            (hub.isin(*V.ZONE_UPCOUNTRY_HUBS), "UPC"),
            (region.isNull(), "4PL"),
            (~region.isin("GBKK", "4PL"), "UPC"),
        ],
        region,
    )


def later_failure(failed_at: Column, last_at: Column, hub: Column) -> tuple[Column, Column, Column]:
    """(hub, time, 'others' or 'mm') of a failed operation after the last event. It counts for
    others when a hub, first-mile, drop-off or partner station logged it."""
    is_later = failed_at > last_at
    by_others = is_later & starts_with_any(hub, "H", "F", "D", "4")
    return (
        F.when(is_later, hub),
        F.when(is_later, failed_at),
        F.when(by_others, "others").otherwise("mm"),
    )
