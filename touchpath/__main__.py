"""Command line: one daily load of the attribution tables.

    python -m touchpath run --export PATH --ads-root PATH --out PATH --run-date 2024-01-31
        [--variant gclid|urlparam] [--no-tests]
    python -m touchpath explain --export PATH --ads-root PATH --run-date 2024-01-31 [--model daily]

``--export`` is the analytics export (``events_YYYYMMDD`` shard folders);
``--ads-root`` holds one folder per account table, named
``click_stats_<account>``, ``campaigns_<account>`` and, if any,
``shopping_products_<account>`` (partitioned by ``_partition_date``).  The first run of an empty ``--out`` is a full refresh,
later runs are incremental.
"""

from __future__ import annotations

import argparse
from datetime import date, timedelta


#: What a dev run writes: table -> chain attribute.
DEV_TABLES = {"base_events": "base", "gclid_campaigns": "gclid_campaigns", "silent_sessions": "silent_sessions",
              "traffic_events": "traffic", "session_first_last_source": "first_last",
              "session_channel_groups": "channel_groups", "session_starts": "session_starts", "daily_sessions": "daily"}


def declared_sources(args):
    """The registry that the command line describes."""
    from touchpath.sources.ads import SourceRegistry, account_labels

    names = lambda text: [c for c in text.split(",") if c]
    registry = SourceRegistry.declared(args.ads_root, account_labels(names(args.performance_countries), names(args.brand_countries)),
                                       names(args.shopping_accounts))
    for entry in args.source:
        name, _, path = entry.partition("=")
        registry.register(name, path)
    return registry


def show_sources(args) -> None:
    from touchpath.session import get_session

    spark = get_session(app="touchpath-sources")
    registry = declared_sources(args)
    if args.sql:
        registry.create_views(spark, only_present=True)
        spark.sql(args.sql).show(100, truncate=False)
    elif args.name:
        table = registry.table(spark, args.name)
        table.printSchema()
        table.show(20, truncate=False)
    else:
        for name, there in sorted(registry.present(spark).items()):
            print(f"{name}\t{registry.entries[name]}\t{'present' if there else 'absent'}")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="touchpath")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="advance the model tables to a run date")
    run.add_argument("--export", required=True)
    run.add_argument("--ads-root")
    run.add_argument("--out", required=True)
    run.add_argument("--run-date", type=date.fromisoformat, default=date.today())
    run.add_argument("--variant", choices=("gclid", "urlparam"), default="gclid")
    run.add_argument("--no-tests", action="store_true")
    run.add_argument("--site", default="shop", help="own site name stripped from page paths")
    run.add_argument("--performance-countries", default="de,at",
                     help="countries with a performance ad account (comma separated)")
    run.add_argument("--brand-countries", default="de,at,ch",
                     help="countries with a brand ad account (comma separated)")
    run.add_argument("--dev", action="store_true", help="dev run: last two days, sampled export")
    run.add_argument("--dev-sampling", choices=("blocks", "events"), default="blocks",
                     help="dev run: read a sample of the export's files, or all files and keep a sample of their events")
    run.add_argument("--first-last-days", type=int, default=None,
                     help="sessions that the look-back reads (default: all; too few are refused)")
    run.add_argument("--reload-days", type=int, default=2, help="days reloaded by an incremental run")
    run.add_argument("--carry-names", action="store_true", help="a campaign without a name keeps its last one, also of earlier days")
    run.add_argument("--allow-missing", action="store_true", help="let wanted days have no shard (a reload empties them)")
    run.add_argument("--shopping-accounts", default="", help="accounts with a shopping_products_<account> table")
    run.add_argument("--source", action="append", default=[], metavar="NAME=PATH",
                     help="location of a named source table, instead of the folder below --ads-root")
    ex = sub.add_parser("explain", help="print the physical plan of a model for a run date")
    ex.add_argument("--export", required=True)
    ex.add_argument("--ads-root")
    ex.add_argument("--run-date", type=date.fromisoformat, default=date.today())
    ex.add_argument("--variant", choices=("gclid", "urlparam"), default="gclid")
    ex.add_argument("--model", default="channel_groups",
                    help="chain attribute: base, silent_sessions, traffic, first_last, channel_groups, "
                         "session_starts, daily, gclid_campaigns")
    so = sub.add_parser("sources", help="list the declared ad-account tables, show one, or query them by name")
    so.add_argument("--ads-root", required=True)
    so.add_argument("--performance-countries", default="de,at")
    so.add_argument("--brand-countries", default="de,at,ch")
    so.add_argument("--shopping-accounts", default="de,at")
    so.add_argument("--source", action="append", default=[], metavar="NAME=PATH")
    so.add_argument("--name", help="show this table's columns and first rows")
    so.add_argument("--sql", help="run this query over views of all tables that are there")
    args = ap.parse_args(argv)

    if args.cmd == "sources":
        show_sources(args)
        return

    if args.cmd == "explain":
        from touchpath.config import RunConfig
        from touchpath.plans.chain import chain_from_paths
        from touchpath.session import get_session
        spark = get_session(app="touchpath-explain")
        chain = chain_from_paths(spark, args.export, RunConfig(run_date=args.run_date),
                                 ads_root=args.ads_root, variant=args.variant, durable=())
        getattr(chain, args.model).explain("formatted")
        return

    from touchpath.session import get_session
    from touchpath.sources.ads import SourceRegistry
    from touchpath.sources.ga4 import EXPORT_SCHEMA, read_ga4_shards
    from touchpath.streaming.incremental import IncrementalRunner

    spark = get_session(app="touchpath-run")
    registry = SourceRegistry()
    if args.variant == "gclid":
        if not args.ads_root:
            raise SystemExit("--ads-root is needed for the gclid variant")
        registry = declared_sources(args)
    from touchpath.config import RunConfig
    base_cfg = RunConfig(run_date=args.run_date, site=args.site, first_last_days=args.first_last_days,
                         reload_days=args.reload_days)
    runner = IncrementalRunner(spark, args.out, None, registry.clicks, registry.campaigns, variant=args.variant,
                               base_cfg=base_cfg, shopping_tables=registry.shopping, carry_names=args.carry_names)
    # a first (full) load reads the widest window any model reads, 120 days;
    # later loads the reload days and what was skipped since the last run
    days = [args.run_date - timedelta(days=i) for i in (1, 2)] if args.dev else runner.reload_days(args.run_date)
    missing = "allow" if args.allow_missing else "leading" if len(days) == 120 else "raise"
    blocks = args.dev and args.dev_sampling == "blocks"
    raw = runner.raw_events = read_ga4_shards(spark, args.export, days=days, schema=EXPORT_SCHEMA, missing=missing,
                                              sample_percent=base_cfg.dev_sample_percent if blocks else None, seed=base_cfg.sample_seed)
    if args.dev:
        # a dev run reads and writes the last two days only, from a sample
        from touchpath.plans.chain import Chain
        from touchpath.sources.sinks import write_full
        chain = Chain(spark=spark, raw_events=raw, click_tables=registry.clicks, campaign_tables=registry.campaigns,
                      cfg=base_cfg.with_(mode="dev", dev_sampling=args.dev_sampling), variant=args.variant)
        for name, attr in DEV_TABLES.items():
            if name == "gclid_campaigns" and args.variant != "gclid":
                continue
            path = f"{args.out.rstrip('/')}/dev_{name}"
            write_full(getattr(chain, attr), path, partition_by="date" if name == "gclid_campaigns" else "event_date_dt")
            print(f"dev_{name}\t{path}")
        chain.close()
        return
    for name, path in runner.run(args.run_date, with_tests=not args.no_tests).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
