from txnguard.operators.enrich import (
    add_calendar, enrich_with_baseline, enrich_with_blacklist, enrich_with_device,
    enrich_with_entity_blacklist, enrich_with_entity_blacklist_asof, validity_segments,
)
from txnguard.operators.rules import Rule, apply_rules, blend, default_rules, flags_text
from txnguard.operators.velocity import self_velocity, sliding_velocity, trailing_velocity

__all__ = ["add_calendar", "enrich_with_baseline", "enrich_with_blacklist", "enrich_with_device",
           "enrich_with_entity_blacklist", "enrich_with_entity_blacklist_asof", "validity_segments",
           "Rule", "apply_rules", "blend", "default_rules", "flags_text",
           "self_velocity", "sliding_velocity", "trailing_velocity"]
