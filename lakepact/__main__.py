"""Command line / job entry point: ``python -m lakepact ...`` or, on a cluster,
``spark-submit lakepact/__main__.py ...`` (the package installed or the checkout on the path).

  apply  CONTRACT ENV FILE...   load a delivery: structure, gate, publish, post-check
  apply-all JOBS.yaml ENV       one independent load per task: [{contract: .., files: [..]}, ..]
  check  CONTRACT [SERVER]      run the checks on the contract's declared file source
  diff   OLD_DIR NEW_DIR        compare two folders of contracts; exit 1 on breaking changes
  ddl    CONTRACT ENV           print the table DDL for an environment

Exit codes: 0 success, 1 checks failed / breaking change / refused structure, 2 usage error.
The report rows printed are the one-row-per-check reports (small by construction).
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):  # run as a script file (spark-submit path/to/__main__.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("lakepact").getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _print_report(title: str, rows) -> None:
    bad = [r for r in rows if r["result"] == "failed"]
    print(f"{title}: {'PASSED' if not bad else 'FAILED'} - {len(rows)} checks, {len(bad)} failed")
    for r in (bad or rows):
        print(f"  {r['result']:7s} {r['check']:45s} {r['metric']!s:>12s}  {r['detail']}")


def main(argv: list[str] | None = None) -> int:
    from lakepact import Contract, EvolutionRefused, GateFailed, TableCheckFailed, apply_contract
    from lakepact.contract import resolve_target
    from lakepact.operators.diff import changelog, contract_diff, diff_verdict, overall_verdict
    from lakepact.operators.publish import create_table_ddl
    from lakepact.plans.apply import check_declared_source
    from lakepact.session import lake_root
    from lakepact.sources.registry import read_contract_registry

    ap = argparse.ArgumentParser(prog="python -m lakepact", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("apply")
    a.add_argument("contract")
    a.add_argument("env")
    a.add_argument("files", nargs="+")
    a.add_argument("--post-check", default="full", choices=["full", "schema", "none"])
    a.add_argument("--malformed-rows", action="store_true")
    aa = sub.add_parser("apply-all")
    aa.add_argument("jobs")
    aa.add_argument("env")
    aa.add_argument("--parallel", type=int, default=4)
    c = sub.add_parser("check")
    c.add_argument("contract")
    c.add_argument("server", nargs="?", default="local")
    d = sub.add_parser("diff")
    d.add_argument("old")
    d.add_argument("new")
    g = sub.add_parser("ddl")
    g.add_argument("contract")
    g.add_argument("env")
    args = ap.parse_args(argv)

    if args.cmd == "ddl":
        contract = Contract.load(args.contract)
        target = resolve_target(contract, args.env)
        name = target.spark_name()
        print(create_table_ddl(contract, name, f"<lake root>/{target.namespace()}/{target.table}/{target.table}_v0"))
        return 0

    spark = _session()
    if args.cmd == "apply":
        contract = Contract.load(args.contract)
        post = {"full": True, "schema": "schema", "none": False}[args.post_check]
        try:
            res = apply_contract(spark, contract, args.env, args.files, post_check=post,
                                 malformed_rows=args.malformed_rows)
        except GateFailed as e:
            _print_report("gate", e.report)
            print(str(e))
            return 1
        except TableCheckFailed as e:
            _print_report("post-load", e.report)
            return 1
        except EvolutionRefused as e:
            print(str(e))
            return 1
        for action in res.actions:
            print(action)
        _print_report("gate", res.gate)
        print(f"loaded {res.rows_loaded} rows into {res.table} (lake root {lake_root(spark)})")
        if res.surplus_columns:
            print(f"columns not in the contract, dropped: {', '.join(res.surplus_columns)}")
        return 0
    if args.cmd == "apply-all":
        import yaml

        from lakepact.plans.apply import apply_all

        with open(args.jobs, encoding="utf-8") as fh:
            tasks = yaml.safe_load(fh) or []
        jobs = [(Contract.load(t["contract"]), args.env, list(t["files"])) for t in tasks]
        outcomes = apply_all(spark, jobs, max_parallel=args.parallel)
        for o in outcomes:
            print(f"  {o.status:17s} {o.contract:45s} checks {o.checks:3d} failed {o.failed:3d} rows {o.rows_loaded}")
        return 0 if all(o.status == "loaded" for o in outcomes) else 1
    if args.cmd == "check":
        out = check_declared_source(spark, Contract.load(args.contract), args.server)
        _print_report(f"server {args.server}", out.report)
        return 0 if out.passed else 1
    if args.cmd == "diff":
        old = read_contract_registry(spark, args.old).drop("path")
        new = read_contract_registry(spark, args.new).drop("path")
        diff = contract_diff(old, new)
        for r in changelog(diff).collect():  # one row per difference: a changelog, not data
            print(f"  {r['severity']:11s} {r['contract']} {r['field'] or '':30s} {r['change']}")
        verdict = overall_verdict(diff_verdict(diff, old, new)).collect()[0]
        print(f"{verdict['breaking_contracts']} of {verdict['contracts']} contracts with breaking changes")
        return 0 if verdict["passed"] else 1
    return 2


if __name__ == "__main__":
    sys.exit(main())
