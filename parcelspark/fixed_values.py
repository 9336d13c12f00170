"""Fixed values of the network: status codes, station ids, hub codes, transit limits.

Everything here is data that results depend on. The reports take most of it as defaulted
parameters.
"""

from __future__ import annotations

# Event status codes.
CREATED = (0,)
PICKED_UP = (39, 13)
FIRST_MILE_RECEIVED = (42,)
RECEIVED = (8,)
HANDED_OVER = (18,)
LINEHAUL_LEFT = (15,)
LINEHAUL_ARRIVED = (36,)
LINEHAUL_LOADED = (35,)
DAMAGED_OR_LOST = (11, 12)
DAMAGED_LOST_OR_FOUND = (11, 12, 96)
PARTNER_RECEIVED = (89,)
DELIVERED = (81,)
RETURN_RECEIVED = (58,)
RETURN_PACKED = (62,)
RETURNING = (63, 117)
RETURN_LINEHAUL_LEFT = (64,)
RETURN_STARTED = (10, 58, 95)
LAST_ATTEMPT = (1, 10, 67)
TRIP = (46, 47, 35, 15, 211, 233, 55, 56, 62, 64)

# Statuses of open shipments that can be stuck.
OPEN = (
    8, 9, 15, 18, 32, 33, 34, 35, 36, 40, 47, 48, 56, 57, 58, 59, 60, 61, 62, 63, 64, 65, 66,
    86, 87, 114, 117, 118, 233, 234,
)
# Departures and arrivals between stations; loaded on a vehicle.
LEFT_STATION = (47, 15, 233, 56, 64)
ON_THE_ROAD = (47, 48, 15, 36, 233, 234, 56, 57, 64, 65)

# Departures with their arrivals, as the lead-time report pairs them; statuses it
# leaves out; statuses after which the clock stops.
LEADTIME_DEPARTED = (47, 15, 233, 56, 64, 235, 86)
LEADTIME_ARRIVED = (48, 36, 234, 57, 65, 236, 87)
LEADTIME_IGNORED = (0, 7, 30, 31, 37, 38)
LEADTIME_TERMINAL = (3, 4, 6, 11, 14, 26, 51, 73, 81, 96, 125, 145, 146, 189, 190)

# Backlog statuses whose hub is the destination in the event text, or the
# station of the last attempt.
BACKLOG_AT_DESTINATION = (15, 36, 64, 65)
BACKLOG_AT_LAST_ATTEMPT = (2, 5, 49, 50, 119, 120, 115, 116)

# Backlog columns and the statuses each counts.
_FM_FWD_PROCESSING = (42, 43, 44, 45, 46)
_FM_RTN_PROCESSING = (67, 68, 69, 70, 71, 115, 116, 72, 74)
_LM_FWD_PROCESSING = (1, 2, 5, 49, 50, 137, 210, 211)
_LM_RTN_PROCESSING = (10, 52, 53, 54, 55, 119, 120, 124, 126)
_FM_FWD = (39, 40, *_FM_FWD_PROCESSING, 47)
_FM_RTN = (151, 179, *_FM_RTN_PROCESSING, 235)
_LM_FWD = (*_LM_FWD_PROCESSING, 15, 36, 233)
_LM_RTN = (64, 65, *_LM_RTN_PROCESSING, 56)
BACKLOG = (*_LM_FWD, *_LM_RTN, *_FM_FWD, *_FM_RTN)
BACKLOG_COLUMNS = {
    "FM Module Forward Incoming": (39,),
    "FM Module Forward Inbound": (40,),
    "FM Module Forward Processing": _FM_FWD_PROCESSING,
    "FM Module Forward Outbound": (47,),
    "FM Module Forward Total": _FM_FWD,
    "FM Module Return Incoming": (151,),
    "FM Module Return Inbound": (179,),
    "FM Module Return Processing": _FM_RTN_PROCESSING,
    "FM Module Return Outbound": (235,),
    "FM Module Return Total": _FM_RTN,
    "FM Module All Total": (*_FM_FWD, *_FM_RTN),
    "LM Module Forward Incoming": (15,),
    "LM Module Forward Inbound": (36,),
    "LM Module Forward Processing": _LM_FWD_PROCESSING,
    "LM Module Forward Outbound": (233,),
    "LM Module Forward Total": _LM_FWD,
    "LM Module Return Incoming": (64,),
    "LM Module Return Inbound": (65,),
    "LM Module Return Processing": _LM_RTN_PROCESSING,
    "LM Module Return Outbound": (56,),
    "LM Module Return Total": _LM_RTN,
    "LM Module All Total": (*_LM_FWD, *_LM_RTN),
    "All Total": BACKLOG,
}

# Station ids. Regional centres differ in which list they are on.
SORT_CENTRES = (3, 242)
RETURN_CENTRE = 3
PICKUP_CENTRES = (71, 77, 82, 983, 1479, 1480)
DELIVERY_CENTRES = (71, 77, 82, 983, 1350, 1479, 1480)
ALL_CENTRES = (71, 77, 78, 82, 983, 1350, 1479, 1480)

# Station names.
REGIONAL = ("NERC-A", "NERC-B", "NORC-A", "NORC-B", "SORC-A", "SORC-B", "CERC")
SORT_CENTRE_NAMES = ("SOCE", "Sorting center", "SOCW")
PARTNER_CARRIERS = ("Flash", "Kerry", "Ninja Van")
LINEHAUL_STATUS_NAMES = (
    "LMHub_LHTransporting", "FMHub_LHTransporting", "Exception_LHTransporting",
    "Return_LMHub_LHTransporting", "Return_SOC_LHTransporting", "SOC_LHTransporting",
)
ZONE_CENTRAL_HUBS = ("SIP-LMHub", "HNKCS", "HGUAI", "HLDLK", "HPEAW", "HPMSK", "LMBKY")
ZONE_UPCOUNTRY_HUBS = ("HAUTH", "HTSLA", "HCOCH")

# Delivery hubs of each regional centre. The first-mile station of a hub has the
# same code with F in place of H.
HUBS_OF_REGION = {
    "NORC-A": (
        "HPHIT-A", "HPHIT-B", "HWTNG", "HKPET", "HTAKK", "HMSOD", "HNANN", "HPJIT", "HPBUN",
        "HLOMS", "HPRAE", "HLOEI", "HTHAI", "HSWKL", "HUTTA",
    ),
    "NORC-B": (
        "HSRPI", "HCMAI-A", "HCMAI-B", "HSSAI", "HMRIM", "HDSKT", "HCDAO", "HFRNG", "HSTNG",
        "HDONG", "HSANK", "HPAAN", "HCRAI", "HMSAI", "HMJUN", "HPYAO", "HLPNG", "HLPUN",
    ),
    "NERC-A": (
        "HKRAT-A", "HKRAT-B", "HKRAT-C", "HNSUG", "HCOCH", "HPAKC", "HPIMY", "HBUAY", "HSKIU",
        "HDKTD", "HPTCI", "HKNBR", "HSNEN", "HPHUK", "HCYPM", "HBRAM", "HLPMT", "HSTUK",
        "HNRNG", "HPKCI", "HYASO", "HSSKT", "HSRIN", "HSKPM", "HPSAT", "HUBON-A", "HUBON-B",
        "HWRIN", "HDUDM",
    ),
    "NERC-B": (
        "HKKAN-B", "HKKAN-A", "HBPAI", "HCPAE", "HKLSN", "HYTAD", "HNKPN", "HTPNM", "HMKAM",
        "HKSPS", "HKTWC", "HMDHN", "HROET", "HSKON", "HNKAI", "HPSAI", "HUDON-A", "HUDON-B",
    ),
    "SORC-A": (
        "HPPIN", "HSMUI", "HSRAT", "HKDIT", "HBNSN", "HKRBI", "HCPON", "HPTIL", "HSAWE",
        "HTSNG", "HCOUD", "HNKSI", "HTYAI", "HTSLA", "HSICN", "HTLNG", "HPHKT-A", "HPHKT-B",
        "HRNNG",
    ),
    "SORC-B": (
        "HHYAI-B", "HHYAI-A", "HSKLA", "HSDAO", "HTANG", "HNARA", "HPTNI", "HKGPO", "HMYOR",
        "HYLNG", "HPATL", "HKUKN", "HYALA", "HRMAN", "HSTUN",
    ),
    "CERC": (
        "HSWAN", "HTAKI", "HBPIN", "HAYUT", "HSENA", "HAUTH", "HWNOI", "HLOPB", "HKSRG",
        "HCBDN", "HPTNK", "HKKOI", "HSRBR", "HBAMO", "HPTBT", "HNKAE", "HSING", "HTONG",
    ),
}

# Transit limits by pickup centre, in hours. `depart` and `arrive` are added to
# the leg's time before its date is compared; `travel` is the longest drive. Two entries per
# field where the north is treated apart: (to NORC-x, elsewhere).
PICKUP_LIMITS = {
    "CERC": {"depart": -5, "arrive": (-9, -9), "travel": (4, 4), "onward_sign": -1},
    "NERC-A": {"depart": -5, "arrive": (-10, -10), "travel": (5, 5), "onward_sign": -1},
    "NERC-B": {"depart": -5, "arrive": (-11, -10), "travel": (8, 5), "onward_sign": -1},
    "NORC-A": {"depart": -3, "arrive": (-10, -10), "travel": (7, 7), "onward_sign": -1},
    "NORC-B": {"depart": 2, "arrive": (-10, -10), "travel": (12, 12), "onward_sign": 1},
    "SORC-B": {"depart": 5, "arrive": (-11, -11), "travel": (16, 16), "onward_sign": 1},
}
# Hours the sort centre has to send on, by delivery centre.
ONWARD_HOURS = {
    "NERC-A": 17, "NERC-B": 16, "NORC-A": 17, "NORC-B": 16, "SORC-A": 13, "SORC-B": 12, "CERC": 18,
}

# Partners that delivery stations are named after: what a station code contains, and the partner's name; and the
# partner that shipments go to otherwise.
PARTNER_HUBS = (("Kerry", "Kerry"), ("Ninja", "Ninja van"))
DEFAULT_PARTNER = "Flash"
