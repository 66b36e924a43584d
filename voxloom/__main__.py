"""Command line: ``python -m voxloom <command>`` or through ``spark-submit``."""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import SparkSession

from .plans import build as batch
from .plans import merge, pack, repair, report
from .session import RECOMMENDED, ship_package
from .sources import profile, scan
from .specs import REGISTRY, spec_for
from .streaming.incremental import IncrementalBuild


def _named(name: str | None):
    """The function ``module:function``."""
    if not name:
        return None
    module, function = name.split(":")
    return getattr(import_module(module), function)


def _show(df) -> None:
    df.show(max(1, df.count()), truncate=False)  # reports: whole, however long


def cmd_build(spark, a) -> None:
    paths = batch.build(spark, spec_for(a.source), a.raw, f"{a.out}/{a.source}", a.smoke, _named(a.decoder),
                        _named(a.extra), a.audio_files, a.tolerant, a.by_schema)
    staged = batch.staged(spark, paths)
    _show(report.build_report(staged))
    dropped = batch.dropped_rows(spark, paths)
    _show(report.reason_histogram(dropped))
    _show(report.code_histogram(dropped))
    repair.require_good(batch.kept_rows(spark, paths), spec_for(a.source).signal.target_sr)


def cmd_update(spark, a) -> None:
    job = IncrementalBuild(spark, spec_for(a.source), a.raw, f"{a.out}/{a.source}", decoder=_named(a.decoder),
                           extra=_named(a.extra), audio_files=a.audio_files, tolerant=a.tolerant)
    job.run(force=a.force)
    _show(job.totals())
    repair.require_good(job.kept(), spec_for(a.source).signal.target_sr)


def cmd_merge(spark, a) -> None:
    parts = [batch.kept_rows(spark, batch.BuildPaths(f"{a.out}/{s}")) for s in a.sources]
    _show(merge.merge_corpus(spark, parts, a.corpus, a.compact))


def cmd_report(spark, a) -> None:
    corpus = scan.read_keyed(spark, a.corpus)
    for of in (report.corpus_totals, report.source_summary, report.split_summary, report.snr_histogram, report.snr_stats, report.rms_stats,
               report.duration_histogram, report.duration_stats, report.rate_histogram, report.rate_stats):
        _show(of(corpus))


def cmd_check(spark, a) -> None:
    repair.require_good(scan.read_keyed(spark, a.corpus))
    print("all checks passed")


def cmd_dedup(spark, a) -> None:
    print(repair.dedup_table(spark, a.corpus))


def cmd_profile(spark, a) -> None:
    for spec in REGISTRY:
        try:
            raw = scan.scan_parquet(spark, *scan.locate(spark, spec, a.raw)[:1])
        except FileNotFoundError as missing:
            print(f"{spec.name}: {missing}")
            continue
        present = [c for c in spec.text_cols if c in raw.columns]
        _show(profile.profile(raw, spec.name, present[0] if present else None))


def cmd_pack(spark, a) -> None:
    print(f"records without audio: {pack.pack(spark, a.metadata, a.audio, a.out)}")


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="voxloom")
    commands = top.add_subparsers(required=True)

    def command(name, run, *arguments):
        sub = commands.add_parser(name)
        for flag, options in arguments:
            sub.add_argument(flag, **options)
        sub.set_defaults(run=run)

    source, raw, out = ("source", {"choices": [s.name for s in REGISTRY]}), ("--raw", {"default": "raw"}), ("--out", {"default": "processed"})
    corpus = ("--corpus", {"default": "corpus"})
    decoder = ("--decoder", {"help": "module:function from bytes to (samples, rate), for compressed audio"})
    ways = (decoder, ("--extra", {"help": "module:function from annotated rows to rows, run before they are routed"}),
            ("--audio-files", {"help": "folder with the files of rows that only name one"}),
            ("--tolerant", {"action": "store_true", "help": "pass over unreadable raw files"}))
    command("build", cmd_build, source, raw, out, *ways, ("--smoke", {"type": int, "default": 0}),
            ("--by-schema", {"action": "store_true", "help": "read each file with its own schema"}))
    command("update", cmd_update, source, raw, out, *ways, ("--force", {"action": "store_true"}))
    command("merge", cmd_merge, ("sources", {"nargs": "+"}), out, corpus, ("--compact", {"action": "store_true"}))
    command("report", cmd_report, corpus)
    command("check", cmd_check, corpus)
    command("dedup", cmd_dedup, corpus)
    command("profile", cmd_profile, raw)
    command("pack", cmd_pack, ("metadata", {}), ("audio", {}), ("out", {}))
    args = top.parse_args(argv)

    builder = SparkSession.builder.appName("voxloom")
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    args.run(spark, args)


if __name__ == "__main__":
    main()
