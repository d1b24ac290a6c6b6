"""Secret scans: fixed patterns, and character Markov models for what no pattern names.

Two first-order Markov models over characters are trained from labelled
samples: one on strings known to be random (the values that the patterns
find, and encoded digests, also letters only), one on ordinary strings (long
tokens of letters that no pattern touches, names made of them, numbers and
repeated characters). Every long token, and every part of one that a pattern
leaves over, is scored by the mean log-likelihood ratio of its character pairs
under both; above the threshold it is a secret of kind ``random``. The threshold
is the one with the fewest errors on labelled tokens that did not train the models.

All of it is DataFrame functions. Where a pattern matches, the text is split at
the matches; the lengths of the pieces and matches give the places, counted in
code points. A document without a match costs one look of the pattern.

Cases: null and empty texts have no spans. Repeated rows are scanned row by
row. With no labelled sample of a class its model is uniform. An empty table
gives an empty result. Further columns are kept by ``redact``, ignored else.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import written
from .common import fresh, text_or_empty

#: Fixed values of the contract: kind, pattern, and the condition on a match.
#: The shortest length is that of group 2 for ``assign``, of the match else.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 6), ("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24))
#: The same with the least length in the pattern: whether a text needs a closer look.
LOOK = {"assign": ASSIGN.removesuffix("+)") + "{6,})", "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
KINDS = [kind for kind, _, _ in BASE] + ["random"]

#: Tokens that the models look at: at least this many characters of an encoded string.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: At most this many labelled tokens of each class train the models.
SAMPLE_ROWS = 50_000
#: Mean log-likelihood ratio per character pair, less the threshold that the labelled samples set,
#: from which a token counts as random.
THRESHOLD = 0.0
#: One in so many labelled tokens is kept from the training and sets the threshold.
HELD_OUT = 4
#: Weight, in observed pairs, of the frequency of single characters behind each character.
BACKOFF = 20
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CODES = 128  # the tokens are ASCII by their pattern


def _matches(text: Column, pattern: str, value_group: int) -> Column:
    """array of (start, end, value): all leftmost non-overlapping matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    pieces = F.split(text, pattern, -1)
    gaps = F.transform(pieces, lambda p: F.length(p))
    lengths = F.transform(found, lambda m: F.length(m))
    # running places: the state is (end of the last match, matches so far)
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, item: Column) -> Column:
        start = acc["at"] + item["gap"]
        end = start + item["length"]
        return F.struct(
            end.alias("at"), F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("spans")
        )

    items = F.zip_with(
        F.slice(gaps, 1, F.size(found)), lengths, lambda g, n: F.struct(g.alias("gap"), n.alias("length"))
    )
    spans = F.aggregate(items, state, step)["spans"]
    return F.zip_with(
        spans, values, lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("value"))
    )


_SPANS = "array<struct<start:int,end:int,kind:int,value:string>>"


def _labelled(found: Column, kind: int, least: int) -> Column:
    return F.transform(
        F.filter(found, lambda m: F.length(m["value"]) >= least),
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value")
        ),
    )


def _where(text: Column, pattern: str, found: Column) -> Column:
    """``found`` where the pattern matches at all, else no span: most texts cost one look."""
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    """array of (start, end, kind, value) of the fixed patterns, ordered by start, then kind."""
    parts = []
    for kind, (name, pattern, least) in enumerate(BASE):
        found = _labelled(_matches(text, pattern, 2 if name == "assign" else 0), kind, least)
        parts.append(_where(text, LOOK[name], found))
    return F.array_sort(F.concat(*parts))


def candidate_spans(text: Column, taken: Column) -> Column:
    """array of (start, end, kind, value, scored): what the models look at.

    Tokens that the spans in ``taken`` (ordered by start) do not touch, and all
    parts outside these spans of the tokens that they do touch, however short.
    ``scored`` is the value, with the neighbouring character of a span beside it,
    so that a part of one character has a pair.
    """
    found = _labelled(_matches(text, CANDIDATE, 0), len(BASE), 16)

    def parts(c: Column) -> Column:
        inside = F.filter(taken, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"]))
        gap = lambda low, high: F.when(
            low < high, F.array(F.struct(low.alias("start"), high.alias("end")))
        ).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        state = F.struct(c["start"].alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("gaps"))
        gaps = F.aggregate(
            inside,
            state,
            lambda acc, o: F.struct(
                F.greatest(acc["at"], o["end"]).alias("at"),
                F.concat(acc["gaps"], gap(acc["at"], o["start"])).alias("gaps"),
            ),
            lambda acc: F.concat(acc["gaps"], gap(acc["at"], c["end"])),
        )
        return F.transform(gaps, lambda g: _part(c, g["start"], g["end"]))

    # most texts have no span of a pattern: their tokens are taken as they are
    whole = F.transform(found, lambda c: _part(c, c["start"], c["end"]))
    split = F.flatten(F.transform(found, parts))
    none = F.array().cast(_CANDIDATES)
    looked = F.when(F.size(taken) == 0, whole).otherwise(split)
    return F.when(F.rlike(text, F.lit(CANDIDATE)), looked).otherwise(none)


_CANDIDATES = "array<struct<start:int,end:int,kind:int,value:string,scored:string>>"


def _part(token: Column, start: Column, end: Column) -> Column:
    low, high = F.greatest(token["start"], start - 1), F.least(token["end"], end + 1)
    cut = lambda a, b: F.substring(token["value"], a - token["start"] + 1, b - a)
    return F.struct(
        start.alias("start"),
        end.alias("end"),
        token["kind"].alias("kind"),
        cut(start, end).alias("value"),
        cut(low, high).alias("scored"),
    )


def _pairs(tokens: DataFrame, label: str) -> DataFrame:
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("value") - 1),
        lambda i: F.ascii(F.substring("value", i, F.lit(1))) * _CODES + F.ascii(F.substring("value", i + 1, F.lit(1))),
    )
    return tokens.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias(label))


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[float]:
    """For every pair of ASCII characters the log ratio of its probability under both models.

    ``labelled`` has ``random`` (values of the patterns) and ``ordinary`` (one
    token of letters) of each document. The patterns find few alphabets, so
    strings whose label holds by construction are added for each token of
    letters. Random are the base64 form of its SHA-256, the letters of that, and
    these in lower case; ordinary are a name with capitals, underscores and a
    number made of it, a decimal number, and a letter and a rule character repeated. Of each class the ``sample_rows`` distinct tokens with
    the smallest hash are used, one in ``HELD_OUT`` of them to set the threshold,
    which is taken off every ratio. The model is 128 x 128 numbers at any size of
    the input.
    """
    word = F.col("ordinary")
    hashed = F.xxhash64("ordinary")
    number = F.pmod(hashed, F.lit(10_000)).cast("string")
    made = F.concat(F.initcap(word), F.lit("_"), word, number)
    coded = F.base64(F.unhex(F.sha2(word, 256)))
    letters = F.regexp_replace(coded, "[^A-Za-z]", "")
    digits = F.conv(F.substring(F.sha2(word, 256), 1, 15), 16, 10)
    times = (F.pmod(hashed, F.lit(40)) + 16).cast("int")
    at = lambda chars: F.substring(F.lit(chars), (F.pmod(hashed, F.lit(len(chars))) + 1).cast("int"), F.lit(1))
    again, rule = F.repeat(at(LETTERS), times), F.repeat(at("=-_/+"), times)

    def sample(tokens: Column) -> DataFrame:
        tokens = labelled.select(F.explode(tokens).alias("value")).filter(F.col("value").rlike(r"^[\x21-\x7E]{2,}$"))
        chosen = tokens.distinct().orderBy(F.xxhash64("value"), "value").limit(sample_rows)
        return written(chosen.withColumn("held", F.pmod(F.xxhash64("value", F.lit(1)), F.lit(HELD_OUT)) == 0))

    random = sample(F.concat("random", F.array(coded, letters, F.lower(letters))))
    ordinary = sample(F.array(word, made, digits, again, rule))
    counted = _pairs(random.filter("NOT held"), "r").join(_pairs(ordinary.filter("NOT held"), "o"), "pair", "full")
    counts = np.zeros((2, _CODES, _CODES))
    for pair, random_count, ordinary_count in counted.select("pair", "r", "o").collect():  # at most 128 x 128 rows
        counts[:, pair // _CODES, pair % _CODES] = (random_count or 0, ordinary_count or 0)
    # pairs that are rarely seen fall back to how frequent their second character is
    single = counts.sum(axis=1, keepdims=True) + 1
    single /= single.sum(axis=2, keepdims=True)
    shares = (counts + BACKOFF * single) / (counts.sum(axis=2, keepdims=True) + BACKOFF)
    ratios = np.log(shares[0] / shares[1]).ravel()

    held = random.filter("held").select("value", F.lit(True).alias("label"))
    held = held.unionByName(ordinary.filter("held").select("value", F.lit(False).alias("label")))
    bins = held.select("label", F.round(score(F.col("value"), ratios.tolist()) * 100).cast("int").alias("bin"))
    return (ratios - best_threshold(bins.groupBy("bin", "label").count().collect())).tolist()


def best_threshold(bins: list) -> float:
    """Between the scores of both classes, where the shares of wrong labels have the smallest sum.

    ``bins`` has (hundredths of score, whether random, number of tokens); there
    are no more than the range of the scores has hundredths. Without tokens of
    one class it is 0. Of equal sums the one in their middle is taken.
    """
    totals = {label: sum(n for _, of, n in bins if of == label) for label in (True, False)}
    if not all(totals.values()):
        return 0.0
    edges = sorted({b for b, _, _ in bins})
    missed, kept = 0.0, 1.0
    tried = [(kept, edges[0] - 0.5)]
    for at, edge in enumerate(edges):
        for b, label, n in bins:
            if b == edge:
                missed, kept = (missed + n / totals[True], kept) if label else (missed, kept - n / totals[False])
        tried.append((missed + kept, (edge + edges[at + 1]) / 2 if at + 1 < len(edges) else edge + 0.5))
    least = min(wrong for wrong, _ in tried) + 1e-9
    best = [t for wrong, t in tried if wrong <= least]
    return best[len(best) // 2] / 100


def score(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of the character pairs of ``token``."""
    llr = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")  # folded to a constant
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(token) - 1),
        F.lit(0.0),
        lambda acc, i: acc
        + F.get(llr, F.ascii(F.substring(token, i, F.lit(1))) * _CODES + F.ascii(F.substring(token, i + 1, F.lit(1)))),
    )
    return total / (F.length(token) - 1)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table (doc_id, base, candidates, random, ordinary): one scan, texts stay behind.

    ``candidates`` are the tokens and parts for the models; ``ordinary`` is the
    token of letters with the smallest hash that no pattern touches.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    rows = rows.withColumn("base", base_spans(F.col("_text")))
    rows = rows.withColumn("_tokens", candidate_spans(F.col("_text"), F.col("base")))
    letters = F.filter("_tokens", lambda c: (c["scored"] == c["value"]) & c["value"].rlike("^[A-Za-z_-]+$"))
    hashed = F.transform(letters, lambda c: F.struct(F.xxhash64(c["value"]).alias("hash"), c["value"].alias("value")))
    return written(
        rows.select(
            "doc_id",
            "base",
            F.col("_tokens").alias("candidates"),
            F.transform("base", lambda s: s["value"]).alias("random"),
            F.array_min(hashed)["value"].alias("ordinary"),
        )
    )


def _with_model(base: Column, candidates: Column, model: list[float], threshold: float) -> Column:
    added = F.filter(candidates, lambda c: score(c["scored"], model) >= threshold)
    return F.array_sort(F.concat(base, F.transform(added, _span)))


def _span(c: Column) -> Column:
    return F.struct(*[c[name].alias(name) for name in ("start", "end", "kind", "value")])


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(id, base, spans): spans of the patterns, and these with those of the models.

    A span is (start, end, kind, value); kind is the place in KINDS.
    """
    scanned = scan(docs, id_col, text_col)
    spans = _with_model(F.col("base"), F.col("candidates"), train(scanned, sample_rows), threshold)
    return scanned.select(F.col("doc_id").alias(id_col), "base", spans.alias("spans"))


def described(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(
    docs: DataFrame,
    text_col: str = "text",
    mark: str = "[SECRET]",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; all rows and columns stay.

    The texts are scanned twice, for the labels and for the result, and never
    shuffled. Spans that overlap share one mark. A null text stays null.
    """
    keyed = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"))
    model = train(scan(keyed), sample_rows)
    # columns of their own: an expression used inside another's lambda would be computed for every token
    base, tokens, found = (fresh(docs, f"_{name}") for name in ("base", "tokens", "found"))
    rows = docs.withColumn(base, base_spans(text_or_empty(text_col)))
    rows = rows.withColumn(tokens, candidate_spans(text_or_empty(text_col), F.col(base)))
    rows = rows.withColumn(found, _with_model(F.col(base), F.col(tokens), model, threshold))
    text = F.col(text_col)
    # from left to right: the text before a span, then the mark unless the span before reaches into it
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        marked = F.when(s["start"] >= acc["at"], F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"])
        return F.struct(marked.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    clean = F.when(F.size(found) > 0, F.aggregate(F.col(found), state, step, finish)).otherwise(text)
    return rows.withColumn(text_col, clean).drop(base, tokens, found)
