"""python -m loomtext run PAGES OUT [--resume] | more PAGES EXISTING... OUT [--resume] | curate LINES OUT"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .config import EngineConfig
from .operators import generate
from .plans import pipeline
from .sources import jsonl, pdf


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loomtext", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="books to a dataset; PAGES is Parquet (book_id, page_no, text), or PDF files")
    more = commands.add_parser("more", help="a second pass over the same books; pairs that EXISTING JSON lines have are left out")
    for c in (run, more):
        c.add_argument("pages")
        if c is more:
            c.add_argument("existing", nargs="+")
        c.add_argument("out")
        c.add_argument("--resume", action="store_true", help="keep what is there and skip completed chunks")
        c.add_argument("--prompt", help="file with the prompt's template; its fields are {num_pairs} {source_section} {section_type} {chunk_text}")
        c.add_argument("--system", help="file with the system message")
        c.add_argument("--probe", action="store_true", help="ask the generator for two pairs first, and stop if it gives none")
    curate = commands.add_parser("curate", help="validate and deduplicate JSON lines")
    curate.add_argument("lines")
    curate.add_argument("out")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("loomtext").getOrCreate()
    cfg = EngineConfig.from_env()
    spark.sparkContext.setLogLevel({"WARNING": "WARN"}.get(cfg.log_level, cfg.log_level))
    if a.command == "curate":
        pairs = pipeline.curate(jsonl.read_lines(spark, a.lines), cfg)
        jsonl.write_lines(jsonl.to_json_lines(pairs.repartitionByRange("pair_id").sortWithinPartitions("pair_id")), a.out)
        print(json.dumps({"final": pairs.count()}))
        return 0
    generator = generate.backend(cfg, jsonl.read_prompt(a.system) if a.system else generate.SYSTEM)
    if a.probe and not generate.healthy(generator):
        print("stopped: the generator gives no pairs")
        return 1
    is_pdf = a.pages.lower().endswith(".pdf")
    if is_pdf:
        for r in pdf.too_small(spark, a.pages, cfg).toLocalIterator():
            print(f"left out: {r.path} has {r.length} bytes")
    pages = pdf.pages(pdf.files(spark, a.pages, cfg)) if is_pdf else spark.read.parquet(a.pages)
    options = {"resume": a.resume, "generator": generator, "template": jsonl.read_prompt(a.prompt) if a.prompt else generate.TEMPLATE}
    try:
        result = pipeline.run(spark, pages, a.out, cfg, **options) if a.command == "run" else pipeline.second_pass(spark, pages, a.existing, a.out, cfg, **options)
    except pipeline.EmptyStage as e:
        print(f"stopped: {e}")
        return 1
    for r in result.too_short.toLocalIterator():
        print(f"left out: {r.book_id} has {r.word_count} words")
    print(json.dumps(result.counts))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
