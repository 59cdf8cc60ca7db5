"""Command line: ``python -m colloq COMMAND FOLDER ...`` for a study's folder, and ``run`` for a query by name."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from . import catalogue
from .sources.rows import InputProblem
from .study import Study


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="colloq", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *arguments: tuple) -> None:
        p = sub.add_parser(name, help=text)
        for names, options in arguments:
            p.add_argument(*names, **options)

    folder = (("folder",), {})
    add("new", "make a study's folder", folder, (("--subject",), {"required": True}), (("--kind",), {"default": "product"}))
    add("status", "state of the stages", folder)
    add("freeze", "lock the codebook", folder, (("--new-version",), {"action": "store_true"}))
    add("unseal", "copy the sealed expectations, once labels are locked", folder)
    add("round", "close this round and start the next", folder, (("--reason",), {"required": True}))
    add("reset", "move what was generated into the archive", folder)
    add("queries", "names of all queries")
    add("run", "write a query's rows as Parquet or show some", (("query",), {}), (("tables",), {}), (("--out",), {}), (("--show",), {"type": int, "default": 20}))
    return top


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    if a.command == "queries":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    spark = SparkSession.builder.getOrCreate()
    try:
        if a.command == "run":
            df = catalogue.QUERIES[a.query](spark, a.tables)
            if a.out:
                df.write.mode("overwrite").parquet(a.out)
            else:
                df.show(a.show, truncate=False)
            return 0
        study = Study(spark, a.folder)
        done = {
            "new": lambda: study.create(a.subject, a.kind) if a.command == "new" else None, "status": study.status, "freeze": lambda: study.freeze(a.new_version), "unseal": study.unseal,
            "round": lambda: study.next_round(a.reason), "reset": study.reset,
        }[a.command]()
        if done is not None:
            print(json.dumps(done, indent=2, ensure_ascii=False))
        return 0
    except InputProblem as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
