"""Language identification by Bayesian evidence fusion (operator 1).

For every row the log posterior of each language adds up
* the text: mean log likelihood of its hashed byte trigrams under the language's
  multinomial, times the number of trigrams, at most ``EVIDENCE`` (neighbouring
  trigrams are not independent);
* the declared markup language: P(declared | language), learned from all rows;
* the address suffix (last label of the host): P(suffix | language), learned from all rows;
* the host prior, smoothed hierarchically: the table's language shares, then the
  registered domain's (last two labels), then the host's, each shrunk to the level above.
The three tables are grouped aggregations over all rows of the text-only posteriors
(soft counts); a row's own share is taken out of its domain and host before it is judged.

The text model is fitted on a bounded sample: at most ``TRAIN_ROWS`` distinct labelled documents,
chosen by a hash of id, text and label.  It has ``BUCKETS`` numbers a language.  The languages are
an argument; ``label_languages`` takes them from the labels of all rows, the ``MOST_LANGUAGES`` most frequent at most.

Edge cases: a null or empty text has no trigrams, so only the other evidence counts (and
``text_lang`` is null); a null or
unknown declaration, a null host or suffix are values of their own and count like any other;
without any evidence the language shares decide, ties going to the first language in order;
repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import join_null_safe
from ..session import materialize
from . import bytesops as B
from .sampling import distinct_sample

#: languages of a table without labels
LANGUAGES = ("de", "en", "es", "fr")
MOST_LANGUAGES = 64
TRAIN_ROWS = 20_000
PARTS = 8
BUCKETS = 1 << 15
EVIDENCE = 200
#: pseudo-rows of the level above in a domain's and a host's prior
DOMAIN_ROWS, HOST_ROWS = 5.0, 5.0
#: weight of an unseen declaration or suffix
UNSEEN = 0.5


def trigrams(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams (A-Z lower-cased, runs of whitespace and digits as they are) and row borders."""
    data, offsets = B.buffers(text)
    if len(data) < 3:
        return np.empty(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
    d = B.LOWER[data].astype(np.uint32)
    h = (d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA77) + d[2:] * np.uint32(0xC2B2AE3D)).astype(np.uint32)
    h ^= h >> np.uint32(15)
    code = (h * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int64) % BUCKETS
    inside = np.ones(len(code), dtype=bool)
    for back in (1, 2):
        cross = offsets[1:-1] - back
        inside[cross[(cross >= 0) & (cross < len(code))]] = False
    count = np.zeros(len(code) + 1, dtype=np.int64)
    np.cumsum(inside, out=count[1:])
    return code[inside], count[np.minimum(offsets, len(code))]


def label_languages(labelled: DataFrame, most: int = MOST_LANGUAGES) -> tuple[str, ...]:
    """The languages of ``labelled`` (lang), in lower case and in order: of its labels the ``most`` frequent, ties to the
    first in order; ``LANGUAGES`` where no row has a label."""
    label = F.lower(F.trim("lang"))
    counts = labelled.filter(label != "").groupBy(label.alias("lang")).agg(F.count(F.lit(1)).alias("rows"))
    return tuple(sorted(r["lang"] for r in counts.orderBy(F.col("rows").desc(), "lang").limit(most).collect())) or LANGUAGES


def fit_text(labelled: DataFrame, languages: tuple = LANGUAGES, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """(languages, BUCKETS) log probabilities from a bounded sample of ``labelled`` (doc_id, text, lang)."""
    known = labelled.select("doc_id", "text", F.lower(F.trim("lang")).alias("lang")).filter(F.col("lang").isin(*languages))
    chosen = distinct_sample(known, train_rows, "language_sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in batches:
            for part in B.slices(batch, "text"):
                code, border = trigrams(part.column("text"))
                of = np.array([languages.index(x) for x in part.column("lang").to_pylist()], dtype=np.int64)
                table += np.bincount(np.repeat(of, np.diff(border)) * BUCKETS + code, minlength=table.size).reshape(table.shape)
        yield pa.RecordBatch.from_arrays([pa.array([table.astype(np.int32).tobytes()], pa.binary())], ["counts"])

    total = np.zeros((len(languages), BUCKETS), dtype=np.int64)
    for r in chosen.select("text", "lang").repartition(PARTS).mapInArrow(run, "counts binary").collect():  # PARTS rows of fixed size
        total += np.frombuffer(r["counts"], dtype=np.int32).reshape(total.shape)
    smooth = total + 0.5
    return np.log(smooth / smooth.sum(axis=1, keepdims=True))


def text_evidence(rows: DataFrame, model: np.ndarray, evidence: int = EVIDENCE) -> DataFrame:
    """``rows`` (with a ``text`` column) with ``ll``, the text's log likelihood of each language, for the text."""
    others = [c for c in rows.columns if c != "text"]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                code, border = trigrams(part.column("text"))
                n = np.diff(border)
                weight = np.minimum(n, evidence) / np.maximum(n, 1)
                ll = np.stack([B.row_sums(m[code], border) * weight for m in model], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in others], pa.array(ll.tolist(), pa.list_(pa.float64()))], [*others, "ll"]
                )

    return rows.mapInArrow(run, f"{kinds}, ll array<double>")


def _normalised(logs: Column) -> Column:
    """Probabilities from log weights."""
    weights = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def identify(rows: DataFrame, model: np.ndarray, languages: tuple = LANGUAGES) -> DataFrame:
    """``rows`` (text, declared, host and any others) with lang, posterior, posteriors and
    text_lang (what the text alone says)."""
    n = len(languages)
    declared = F.when(F.col("declared").isin(*languages), F.col("declared")).otherwise(F.when(F.col("declared").isNotNull(), "other"))
    labels = F.split("host", r"\.")
    seen = text_evidence(rows.withColumn("declared", declared), model)
    seen = seen.withColumns({
        # a text without trigrams says nothing and teaches nothing
        "text_p": F.when(F.exists("ll", lambda x: x != 0), _normalised(F.col("ll"))).otherwise(F.array(*[F.lit(0.0)] * n)),
        "suffix": F.element_at(labels, -1),
        "domain": F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), "."),
    })
    seen = materialize(seen, "language_text")
    sums = [F.sum(F.get("text_p", i)).alias(f"s{i}") for i in range(n)]
    gathered = lambda *by: seen.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums)
    world = gathered().first()
    total = [(world[f"s{i}"] or 0.0) + 1.0 for i in range(n)]
    shares = [t / sum(total) for t in total]

    def likelihood(by: str) -> DataFrame:
        """log P(value | language) of every value of a column, as an array."""
        t = gathered(by)
        logs = [F.log((F.col(f"s{i}") + UNSEEN) / F.lit(total[i])) for i in range(n)]
        return materialize(t.select(by, F.array(*logs).alias(f"{by}_ll")), f"language_{by}")

    mass = lambda by: materialize(gathered(by).select(by, F.array(*[F.col(f"s{i}") for i in range(n)]).alias(f"{by}_n")), f"language_{by}")
    known = seen
    for by, table in (("declared", likelihood("declared")), ("suffix", likelihood("suffix")), ("domain", mass("domain")), ("host", mass("host"))):
        known = join_null_safe(known, table, [by])
    own, base = F.col("text_p"), F.array(*[F.lit(s) for s in shares])
    rest = lambda by: F.zip_with(F.col(f"{by}_n"), own, lambda a, b: F.greatest(a - b, F.lit(0.0)))
    shrunk = lambda counts, prior, weight: F.zip_with(
        counts, prior, lambda c, p: (c + weight * p) / (F.aggregate(counts, F.lit(0.0), lambda a, b: a + b) + weight)
    )
    prior = shrunk(rest("host"), shrunk(rest("domain"), base, DOMAIN_ROWS), HOST_ROWS)
    logs = F.col("ll")
    for part in (F.col("declared_ll"), F.col("suffix_ll"), F.transform(prior, lambda x: F.log(x))):
        logs = F.zip_with(logs, part, lambda a, b: a + b)
    names = F.array(*[F.lit(x) for x in languages])
    best = lambda p: F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))
    out = known.withColumn("posteriors", _normalised(logs))
    keep = [c for c in rows.columns if c != "text"]
    return out.select(*keep, best(F.col("posteriors")).alias("lang"), F.array_max("posteriors").alias("posterior"), "posteriors", F.when(F.array_max("text_p") > 0, best(F.col("text_p"))).alias("text_lang"))


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, host) of ``pages(page_id, url, html)``: the visible text, the primary
    subtag of the html element's lang attribute, the address' host."""
    html = F.coalesce("html", F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&(?:#?\w+);", " ")
    lang = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#:]*)", 1))
    return pages.select("page_id", text.alias("text"), F.when(lang != "", lang).alias("declared"), F.when(host != "", host).alias("host"))


def document_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, declared, host) of ``documents``: the declared language and the source as host."""
    return docs.select("doc_id", "text", F.lower(F.trim("lang")).alias("declared"), F.col("source").alias("host"))
