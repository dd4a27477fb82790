"""touchpath: session traffic-source attribution and channel grouping on Spark.

Raw analytics event exports and ad-click exports go in as DataFrames; the
library derives user and session keys, repairs paid-search source, medium and
campaign values, finds the first and last source of every session, falls back
to the user's last non-direct source inside a look-back window and labels each
session with a rule-based channel group.  Everything is declared with the
DataFrame API so Catalyst and AQE choose the physical plan.
"""

from touchpath.config import RunConfig

__all__ = ["RunConfig", "Chain", "chain_from_paths", "IncrementalRunner",
           "custom_channel_group", "default_channel_group", "event_param"]


def __getattr__(name):
    # lazy: importing the package does not start or need a Spark session
    if name in ("Chain", "chain_from_paths"):
        from touchpath.plans import chain
        return getattr(chain, name)
    if name == "IncrementalRunner":
        from touchpath.streaming.incremental import IncrementalRunner
        return IncrementalRunner
    if name in ("custom_channel_group", "default_channel_group"):
        from touchpath.functions import channels
        return getattr(channels, name)
    if name == "event_param":
        from touchpath.functions.params import event_param
        return event_param
    raise AttributeError(name)
