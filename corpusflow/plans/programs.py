"""The batch programs: text in, text out, one Spark application each.

Run as ``python -m corpusflow <program> INPUT OUTPUT``; OUTPUT is deleted first.
A corpus is a folder of text files, or Parquet with the columns doc_name and
value (``--packed``), which spares listing one file per document.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .. import sinks, sources
from ..operators import clustering, scale, terms, vectors, weights
from .pipeline import Weighted, start_centroids, weigh


def _lists(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """The lists that are given, by the names that ``weigh`` and ``term_frequency`` have for them."""
    skip, found = args.skip_first_line, {}
    if args.stop_words:
        found["stop_words"] = sources.read_stop_words(spark, args.stop_words)
    if args.terms:
        found["term_dict"] = sources.read_term_dictionary(spark, args.terms, skip)
    if args.docs:
        found["doc_dict"] = sources.read_doc_dictionary(spark, args.docs, skip)
    return found


def _corpus(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    lines = sources.read_table(spark, args.input) if args.packed else sources.read_corpus(spark, args.input)
    # without a dictionary the name itself is the id
    return lines if args.docs else lines.withColumnRenamed("doc_name", "doc_id")


def term_frequency(spark: SparkSession, args: argparse.Namespace) -> None:
    counts = terms.term_frequency(_corpus(spark, args), **_lists(spark, args))
    sinks.write_pairs(counts, args.output)


def eliminate(spark: SparkSession, args: argparse.Namespace) -> None:
    triples = scale.written(sources.read_triples(spark, args.input))
    suitable = scale.written(terms.suitable_terms(triples, args.min_total))
    if args.suitable_output:
        sinks.write_pairs(suitable, args.suitable_output)
    sinks.write_triples(terms.eliminate_terms(triples, suitable), args.output)


def top_terms(spark: SparkSession, args: argparse.Namespace) -> None:
    totals = scale.written(terms.term_totals(sources.read_triples(spark, args.input)))
    if args.totals_output:
        sinks.write_pairs(totals, args.totals_output)
    sinks.write_pairs(terms.top_terms(totals, args.k), args.output)


def tf_idf(spark: SparkSession, args: argparse.Namespace) -> None:
    triples = scale.written(sources.read_triples(spark, args.input))
    if args.idf_output:
        sinks.write_pairs(weights.idf(triples, args.n_docs), args.idf_output)
    if args.length_output:
        sinks.write_pairs(weights.doc_length(triples), args.length_output)
    weighted = weights.tf_idf(triples, args.n_docs)
    sinks.write_pairs(weighted.select("term_id", "doc_id", "weight"), args.output)


def dense_vectors(spark: SparkSession, args: argparse.Namespace) -> None:
    weighted = scale.written(sources.read_weights(spark, args.input))
    sinks.write_lines(sinks.vector_lines(vectors.to_dense_vectors(weighted)), args.output)


def _write_run(run: clustering.KMeansRun, iterations: int, output: str, entries_per_line: int | None) -> None:
    """``classes_i``, ``centers_i``, ``loss_i`` and ``top10_i`` for every pass."""
    for i in range(iterations):

        def of_pass(table: DataFrame, i: int = i) -> DataFrame:
            return table.filter(f"iteration = {i}").drop("iteration")

        sinks.write_pairs(of_pass(run.classes), f"{output}/classes_{i}")
        sinks.write_lines(sinks.centroid_lines(of_pass(run.centroids), entries_per_line), f"{output}/centers_{i}")
        sinks.write_pairs(of_pass(run.loss).selectExpr("'Loss' AS name", "loss"), f"{output}/loss_{i}")
        sinks.write_lines(sinks.top_term_lines(of_pass(run.top_terms)), f"{output}/top10_{i}")


def _cluster(weighted: Weighted, args: argparse.Namespace, spark: SparkSession) -> None:
    points = weighted.points()
    if args.independent:
        run = clustering.kmeans_restarts(points, weighted.vocabulary, args.k, args.iterations, args.method, args.seed)
    else:
        if args.centroids:
            start = sources.read_centroids(spark, args.centroids)
        else:
            start = start_centroids(weighted, args.k, args.method, args.seed)
        run = clustering.kmeans_fit(points, start, args.k, args.iterations)
    _write_run(run, args.iterations, args.output, args.entries_per_line)


def kmeans(spark: SparkSession, args: argparse.Namespace) -> None:
    read = sources.read_weights if args.sparse else sources.read_vectors
    points = scale.written(read(spark, args.input))
    _cluster(Weighted(points.select("term_id").distinct(), points, points), args, spark)


def pipeline(spark: SparkSession, args: argparse.Namespace) -> None:
    _cluster(weigh(_corpus(spark, args), **_lists(spark, args), min_total=args.min_total, n_docs=args.n_docs), args, spark)


def _clear(spark: SparkSession, path: str) -> None:
    """Delete an output of an earlier run, whatever it holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusflow", description=__doc__)
    programs = top.add_subparsers(required=True)

    def program(run, text: str) -> argparse.ArgumentParser:
        sub = programs.add_parser(run.__name__.replace("_", "-"), help=text)
        sub.add_argument("input")
        sub.add_argument("output")
        sub.set_defaults(run=run)
        return sub

    def lists(sub: argparse.ArgumentParser) -> None:
        for name in ("stop-words", "terms", "docs"):
            sub.add_argument(f"--{name}", help="one entry per line; left out, nothing is filtered or encoded by it")
        sub.add_argument("--packed", action="store_true", help="the corpus is Parquet with doc_name and value")
        sub.add_argument("--skip-first-line", action="store_true", help="number dictionaries from their second line")

    def run_options(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--k", type=int, default=5)
        sub.add_argument("--iterations", type=int, default=2)
        sub.add_argument("--seed", type=int, default=0)
        sub.add_argument("--method", choices=["uniform", "hash", "docs"], default="hash", help="random start, or documents")
        sub.add_argument("--centroids", help="file of centroids to start from")
        sub.add_argument("--entries-per-line", type=int, help="entries of a centroid on one line (default: all)")
        sub.add_argument("--independent", action="store_true", help="every pass from fresh random centroids")

    lists(program(term_frequency, "corpus folder -> term doc<tab>freq"))
    sub = program(eliminate, "term frequencies -> the same without rare terms")
    sub.add_argument("--min-total", type=int, default=3)
    sub.add_argument("--suitable-output", help="also write the terms that are kept, with their totals")
    sub = program(top_terms, "term frequencies -> most frequent terms")
    sub.add_argument("--k", type=int, default=10)
    sub.add_argument("--totals-output", help="also write the totals of all terms")
    sub = program(tf_idf, "term frequencies -> term doc<tab>weight")
    sub.add_argument("--n-docs", type=int, help="number of documents (default: those in the input)")
    sub.add_argument("--idf-output")
    sub.add_argument("--length-output")
    program(dense_vectors, "weights -> doc|t:w,t:w,...")
    sub = program(kmeans, "vectors -> classes, centers, loss and top terms of each pass")
    sub.add_argument("--sparse", action="store_true", help="input is term doc weight instead of vector lines")
    run_options(sub)
    sub = program(pipeline, "corpus folder -> classes, centers, loss and top terms of each pass")
    lists(sub)
    sub.add_argument("--min-total", type=int, default=3)
    sub.add_argument("--n-docs", type=int)
    run_options(sub)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("corpusflow").getOrCreate()
    if getattr(args, "independent", False) and (args.centroids or args.method == "docs"):
        raise SystemExit("--independent makes its own random start")
    _clear(spark, args.output)
    args.run(spark, args)
