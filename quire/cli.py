"""Command line: one subcommand a phase, over tables in folders.

    python -m quire.cli slice  (--pdfs DIR | --layouts DIR --toc FILE --texts FILE) --output-dir DIR [--max-pages 20]
    python -m quire.cli extract --input-manifest FILE (--pdfs DIR | --pages FILE) --output-dir DIR [--no-emit-md]
    python -m quire.cli format --input-dir DIR --output-dir DIR [--overwrite] [--fail-on-manual-review] [--no-copy-assets]
    python -m quire.cli merge  --input-dir DIR --output-dir DIR [--overwrite] [--allow-upstream-manual-review]

Exit status 1: a failed slice, review where that is a failure, or an output that exists."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quire import schemas as S
from quire.operators import merge
from quire.plans import extract, phases
from quire.session import cut, session
from quire.sources import layout, manifests, pdf, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quire")
    sub = top.add_subparsers(dest="phase", required=True)
    for name in ("slice", "extract", "format", "merge"):
        p = sub.add_parser(name)
        p.add_argument("--output-dir", required=True)
        p.add_argument("--overwrite", action=argparse.BooleanOptionalAction, default=False)
        p.add_argument("--log-level", default="WARN")
        if name == "slice":
            p.add_argument("--pdfs")
            p.add_argument("--layouts")
            p.add_argument("--toc")
            p.add_argument("--texts")
            p.add_argument("--max-pages", type=int, default=20)
        elif name == "extract":
            p.add_argument("--input-manifest", required=True)
            p.add_argument("--pdfs")
            p.add_argument("--pages")
            p.add_argument("--emit-md", action=argparse.BooleanOptionalAction, default=True)
        else:
            p.add_argument("--input-dir", required=True)
            p.add_argument("--fail-on-manual-review", action="store_true")
        if name == "format":
            p.add_argument("--copy-assets", action=argparse.BooleanOptionalAction, default=True)
        if name == "merge":
            p.add_argument("--allow-upstream-manual-review", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    spark.sparkContext.setLogLevel(args.log_level)
    mode = "overwrite" if args.overwrite else "errorifexists"
    out = args.output_dir
    try:
        if args.phase == "slice":
            if args.pdfs:
                files = layout.files(spark, args.pdfs)
                states = cut(layout.open_documents(files, pdf.pages).select("doc_id", "status"))
                states.write.mode(mode).json(f"{out}/states")
                laid, toc = cut(layout.pdf_layouts(files)), cut(layout.pdf_contents(files))
                texts = layout.page_texts(laid)
            else:
                laid, toc, texts = layout.read_layouts(spark, args.layouts), spark.read.schema(S.TOC).json(args.toc), spark.read.schema("doc_id string, page int, text string").json(args.texts)
            slices = phases.slice_phase(toc, laid, texts, args.max_pages)
            slices.write.mode(mode).json(f"{out}/slices")
            stored = spark.read.schema(slices.schema).json(f"{out}/slices")
            sinks.slice_manifests(stored, stored.groupBy("doc_id").agg(F.max("end_page").alias("total_pages"), F.lit(1).alias("fallback_level"))).write.mode(mode).json(f"{out}/manifest")
            if args.pdfs:
                layout.pdf_slices(files, stored, f"{out}/files").write.mode(mode).json(f"{out}/written")
                return int(states.where("status <> 'ok'").limit(1).count() > 0)
            return 0
        if args.phase == "extract":
            rows = manifests.slices(manifests.read(spark, args.input_manifest, "slice"))
            manifests.slice_errors(rows).write.mode(mode).json(f"{out}/errors")
            if spark.read.schema("slice_file string, error_code string").json(f"{out}/errors").limit(1).count():
                return 1
            if args.pdfs:
                slice_files = layout.files(spark, args.pdfs)
                sinks.missing_files(rows, args.pdfs).write.mode(mode).json(f"{out}/missing")
                layout.pdf_images(slice_files, f"{out}/assets").write.mode(mode).json(f"{out}/images")
            found = layout.pdf_pages(slice_files) if args.pdfs else spark.read.schema(extract.PAGES).json(args.pages)
            done = extract.extract_phase(found, rows.select("slice_file", "display_title", "start_page", "end_page", "overlap_pages", "manual_review_required"))
            for name in ("content", "records", "stats"):
                done[name].write.mode(mode).json(f"{out}/{name}")
            sinks.extract_manifests(done["records"], rows).write.mode(mode).json(f"{out}/manifest")
            if args.emit_md:
                extract.drafts(done["content"]).write.mode(mode).json(f"{out}/drafts")
            return int(done["records"].where("status = 'failed'").limit(1).count() > 0)
        if args.phase == "format":
            done = phases.format_phase(spark.read.schema(S.CONTENT).json(f"{args.input_dir}/content"), spark.read.schema("doc_id string, markdown string").json(f"{args.input_dir}/drafts"))
            for name in ("coverage", "issues", "fixes", "documents"):
                done[name].write.mode(mode).json(f"{out}/{name}")
            finished = cut(sinks.numbered(done["documents"]))
            sinks.format_manifests(finished).write.mode(mode).json(f"{out}/manifest")
            reports = sinks.review_reports(done).select("doc_id", F.to_json(F.struct("*")).alias("content")).join(finished.select("doc_id", "folder"), "doc_id").select(F.concat("folder", F.lit("/review_report.json")).alias("name"), "content")
            shown = finished if args.copy_assets else merge.relinked_to_source(finished)
            written = sinks.files(reports.unionByName(shown.select(F.concat("folder", F.lit("/final.md")).alias("name"), F.col("markdown").alias("content"))), f"{out}/files")
            if args.copy_assets:
                paths = finished.select("folder", F.explode(merge.image_references(F.col("markdown"))).alias("name")).where(F.col("name").startswith("assets/"))
                written = written.unionByName(sinks.copied(paths.select("name", F.concat("folder", F.lit("/"), "name").alias("to")), args.input_dir, f"{out}/files"))
            written.write.mode(mode).json(f"{out}/written")
            schema = done["documents"].schema
            review = spark.read.schema(schema).json(f"{out}/documents").where("manual_review_required").limit(1).count()
            return int(bool(review) and args.fail_on_manual_review)
        slices = spark.read.schema("book string, slice long, display_title string, start_page int, end_page int, markdown string, manual_review_required boolean").json(f"{args.input_dir}/documents")
        status = phases.may_merge(slices, args.allow_upstream_manual_review)
        good = slices.join(status.where("status = 'success'"), "book", "left_semi")
        merged = phases.merge_phase(good)
        for name in ("books", "decisions", "warnings"):
            merged[name].write.mode(mode).json(f"{out}/{name}")
        status.write.mode(mode).json(f"{out}/status")
        sinks.merge_reports(merged).write.mode(mode).json(f"{out}/reports")
        sinks.run_summary(merged).write.mode(mode).json(f"{out}/summary")
        return int(status.where(F.col("status") != "success").limit(1).count() > 0)
    except AnalysisException as error:
        print(error, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
