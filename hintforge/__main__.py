"""Command line: `python -m hintforge filter` keeps confident hints of a file, `python -m hintforge run` goes from seeds to results."""

from __future__ import annotations

import argparse
import importlib
from dataclasses import fields

from pyspark.sql import SparkSession

from hintforge.config import Cutoffs, EngineConfig
from hintforge.operators import hints
from hintforge.plans import standard
from hintforge.sources import features


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hintforge", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    one = commands.add_parser("filter", help="hints of a file that reach the thresholds")
    one.add_argument("hints"), one.add_argument("output")
    run = commands.add_parser("run", help="from seeds, genome and proteins to hints, evidence, chains and the export")
    run.add_argument("genome"), run.add_argument("proteins"), run.add_argument("output")
    run.add_argument("--aligner", default=None, help="module:function that aligns a batch; not needed with --alignments")
    for f in fields(EngineConfig):  # but the thresholds, which have options of their own
        flag = f"--{f.name.replace('_', '-')}"
        if isinstance(f.default, bool):
            run.add_argument(flag, action="store_true")
        elif f.default is None:
            run.add_argument(flag, default=None)
        elif isinstance(f.default, (int, float)):
            run.add_argument(flag, type=float if f.name in ("e_value", "min_exon_score") else int, default=f.default)
    for command in (one, run):
        for f in fields(Cutoffs):
            flag = f"--{f.name.replace('_', '-')}"
            if isinstance(f.default, bool):
                command.add_argument(flag, action="store_true")
            else:
                command.add_argument(flag, type=type(f.default), default=f.default)
    return top


def unready(batch):
    raise ValueError("a run without alignments needs an aligner")


def main(args: list[str] | None = None) -> None:
    given = vars(parser().parse_args(args))
    cutoffs = Cutoffs(**{f.name: given.pop(f.name) for f in fields(Cutoffs)})
    spark = SparkSession.builder.appName("hintforge").getOrCreate()
    if given["command"] == "filter":
        features.write_hints(hints.filter_hints(features.read_hints(spark, given["hints"]), cutoffs), given["output"])
        return
    aligner = unready
    if given["aligner"]:
        module, _, name = given["aligner"].partition(":")
        aligner = getattr(importlib.import_module(module), name)
    names = {f.name for f in fields(EngineConfig)}
    config = EngineConfig(cutoffs=cutoffs, **{k: v for k, v in given.items() if k in names})
    out = standard.full_run(spark, given["genome"], given["proteins"], aligner, config)
    features.write_hints(out.combined, f"{given['output']}/hints")
    features.write_hints(out.evidence, f"{given['output']}/evidence")
    for name, part in (("export", out.export), ("chains", out.export.where("src = 'C'"))):
        standard.export_lines(part.orderBy("src", "seqid", "start", "end")).write.text(f"{given['output']}/{name}")


if __name__ == "__main__":
    main()
