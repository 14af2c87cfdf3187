"""python -m sedimenta COMMAND: a folder to documents, JSON to texts and traces, census of traces, texts to vectors."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def corpus(spark: SparkSession, a: argparse.Namespace) -> None:
    from .operators.corpus import summary
    from .operators.documents import generate
    from .plans.durable import exists
    from .sources import adapters, files, sinks

    registry = sinks.read_registry(spark, a.registry) if a.registry else None
    done = files.load_processed(spark, a.output) if a.resume and exists(spark, a.output) else None
    got = generate(spark, a.input, registry, done, adapters.Options(delimiter=a.delimiter, sheet=a.sheet))
    sinks.write_jsonl(got.documents, a.output, "append" if a.resume else "overwrite")
    if a.errors:
        sinks.write_errors(got.errors, a.errors)
    if a.registry:
        sinks.write_registry(got.registry, a.registry)
    print(", ".join(f"{k}: {v}" for k, v in got.figures.items()))
    summary(got.documents).show()


def harvest(spark: SparkSession, a: argparse.Namespace) -> None:
    from .operators.traces import handoff, harvested, traces
    from .plans.durable import materialize
    from .sources.sinks import write_jsonl

    rows = materialize(harvested(spark, a.input))
    write_jsonl(traces(rows), a.output)
    if a.texts:
        write_jsonl(handoff(rows, tuple(a.catalog)), a.texts)


def census(spark: SparkSession, a: argparse.Namespace) -> None:
    from .functions.json_harvest import SCHEMA
    from .operators import corpus as op

    kept = [f for f in SCHEMA.fields if f.name in ("tier", "carga", "claves_texto", "claves_meta")]
    rows = spark.read.schema(type(SCHEMA)(kept)).json(a.input)
    for table in (op.census_tiers(rows), op.census_paths(rows), op.census_meta(rows)):
        table.show(30, False)


def encode(spark: SparkSession, a: argparse.Namespace) -> None:
    from .functions.vectors import encode_texts
    from .sources.files import load_records
    from .sources.sinks import write_vectors

    fields = (a.text_field,) if a.text_field else ("texto", "texto_limpio")
    rows = load_records(spark, a.input, fields)
    write_vectors(rows.withColumn("e", encode_texts(F.col("texto"), a.encoder, a.mode)).select(*rows.columns, "e.*"), a.output)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sedimenta", description=__doc__)
    commands = parser.add_subparsers(required=True)
    for run, extra in (
        (
            corpus,
            [
                ("--registry", {}),
                ("--errors", {}),
                ("--resume", {"action": "store_true"}),
                ("--delimiter", {"default": ","}),
                ("--sheet", {"type": int, "default": 0})
            ]
        ),
        (harvest, [("--texts", {}), ("--catalog", {"action": "append", "default": []})]),
        (census, None),
        (encode, [("--text-field", {}), ("--encoder", {"default": "hash"}), ("--mode", {"default": "passage", "choices": ["query", "passage"]})]),
    ):
        own = commands.add_parser(run.__name__)
        own.add_argument("input")
        if extra is not None:
            own.add_argument("output")
        for flag, more in extra or []:
            own.add_argument(flag, **more)
        own.set_defaults(run=run)
    a = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("sedimenta").getOrCreate()
    from .plans.session import ship

    ship(spark)
    a.run(spark, a)


if __name__ == "__main__":
    main()
