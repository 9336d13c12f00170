"""Values that belong to one network and are therefore never written into a report."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """One parcel network.

    utc_offset_seconds  local wall clock minus UTC; every event time is shown in it
    id_prefix           shipment ids that count in the open-shipment reports ('' = all)
    home_carrier        the network's own carrier name: blank in the partner column of the
                        loss report, and the channel label of the overseas report
    brand_prefix        station-name prefix of the brand's own shops (they count as partner shops)
    agent_mark          text inside the operator name of automatic sorting agents
    """

    utc_offset_seconds: int = 7 * 3600
    id_prefix: str = ""
    home_carrier: str = "HOME"
    brand_prefix: str = "Brand"
    agent_mark: str = "agent"
