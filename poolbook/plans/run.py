"""Command-line runner: backfill windows or refresh one job's fact table.

  python -m poolbook.plans.run backfill --job uniswap_v2 --lake /data/chain \\
      --target /data/dex/liquidity --window 2020-05-04 2020-10-01 --window 2020-10-01 2021-01-01
  python -m poolbook.plans.run refresh --job uniswap_v2 --lake /data/chain --target /data/dex/liquidity

Jobs: every key of ``plans.config.JOBS`` (daily liquidity fact), plus
``balancer_v2`` (by pool), ``balancer_v2_vault`` (vault totals) and
``balancer_flows`` (the flow-based fact).  Without ``--lake`` tables are read
from the session catalog by their qualified names.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from poolbook import schemas
from poolbook.plans.config import JOBS
from poolbook.plans.jobs import build_window
from poolbook.session import build_session
from poolbook.sources import chain
from poolbook.streaming import polling

SPECIAL = {
    "balancer_v2": ("Balancer", "2"),
    "balancer_v2_vault": ("Balancer", chain.VAULT_VERSION),
    "balancer_flows": None,
}


def window_job(tables: chain.ChainTables, name: str, state: str | None = None):
    """(start, end, stored) -> rows, and the table scope.  With a ``state`` folder,
    membership, pool names and flow balances are kept there between runs."""
    if name in JOBS:
        def run(start, end, stored):
            members = names = None
            if state and name in ("curve_v1", "balancer_v1"):
                members = chain.extend_members(tables, name, state, end)
            if state and (JOBS[name].project, JOBS[name].version) in chain.LABEL_REGISTRIES:
                names = chain.refresh_label_slice(tables, name, state, end)
            return build_window(JOBS[name], chain.sources_for(tables, name, members=members, names=names), start, end, stored=stored)

        return run, (JOBS[name].project, JOBS[name].version)
    if name == "balancer_v2":
        return (lambda s, e, stored: chain.balancer_v2_window(tables, s, e, stored)), SPECIAL[name]
    if name == "balancer_v2_vault":
        return (lambda s, e, stored: chain.balancer_v2_vault_window(tables, s, e, stored)), SPECIAL[name]
    if name == "balancer_flows":
        flows = chain.flow_state_table(f"{state.rstrip('/')}/flows") if state else None
        return (lambda s, e, stored: chain.balancer_flows_window(tables, s, e, stored, state=flows)), None
    raise SystemExit(f"unknown job {name!r}; choose from {sorted([*JOBS, *SPECIAL])}")


def fact_table(scope, target: str) -> polling.FactTable:
    if scope is None:
        return polling.view_liquidity_table(target, schemas.VIEW_LIQUIDITY)
    return polling.liquidity_table(target, schemas.LIQUIDITY, *scope)


def main(argv: list[str] | None = None, spark=None) -> dict:
    p = argparse.ArgumentParser(prog="poolbook")
    p.add_argument("command", choices=["backfill", "refresh"])
    p.add_argument("--job", required=True)
    p.add_argument("--target", required=True, help="folder of the stored fact table")
    p.add_argument("--lake", help="base folder of chain tables as <schema>/<table>.parquet")
    p.add_argument("--state", help="folder of derived state: members, pool names, flow balances")
    p.add_argument("--window", nargs=2, action="append", metavar=("START", "END"), default=[])
    p.add_argument("--as-of", help="ISO time for refresh (default: now, UTC)")
    args = p.parse_args(argv)

    spark = spark or build_session(profile="cluster")
    tables = chain.ChainTables(spark, base=args.lake)
    job, scope = window_job(tables, args.job, args.state)
    if args.command == "backfill":
        if not args.window:
            raise SystemExit("backfill needs at least one --window START END")
        windows = [(dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for a, b in args.window]
        table = fact_table(scope, args.target)
        counts = polling.backfill(spark, job, table, windows)
        result = {"job": args.job, "windows": [[str(a), str(b)] for a, b in sorted(windows)], "inserted": counts}
    else:
        as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        table = fact_table(scope, args.target)
        result = {"job": args.job, "as_of": as_of.isoformat(), "inserted": polling.refresh(spark, job, table, as_of)}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
