"""Source divergence audit: how far each source's words are from the other sources of its
language, and the terms that it uses most beyond its language's share.

Terms are counted per (language, source); a language keeps the terms that enough of its
documents hold.  Shares are smoothed and rounded down to billionths, so that all results
are exact.  Distances between sources are summed block of terms by block.  The leading
terms of a source come from a dominance skyband: a term's value grows with its count in
the group and falls with its count in the language, and ties go by the term's bytes; so a
term that k others dominate in all three can't be among the first k.  Parts of a group's
terms keep their skybands, these are merged in a tree, and what is left is ranked exactly.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, let_workers_import, map_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What becomes of each byte of a text: A-Z are lower-cased, other ASCII but letters stands
#: between terms.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
#: Terms that a task counts before it passes the counts on.
TASK_TERMS = 300_000
LEAST_DOCS, TOP, PRIOR, SCALE = 30, 50, 5, 1_000_000_000
#: Cells (sources x terms) and terms of a block of distances.
BLOCK_CELLS, BLOCK_TERMS = 1 << 22, 4096
#: Terms of a group in one part, and parts that are merged at once.
PART_TERMS, FAN_IN = 20_000, 32


def skyband(count: np.ndarray, lang_count: np.ndarray, item: list[str], k: int = TOP) -> np.ndarray:
    """Positions of the terms that fewer than ``k`` others dominate: with a count as high or
    higher, a language count as low or lower, and an earlier item.

    In the order of falling count, rising language count and item, dominators come first,
    and a term with k dominators has k among those that are kept."""
    name = np.empty(len(item), np.int64)
    name[sorted(range(len(item)), key=[x.encode("utf-8", "surrogatepass") for x in item].__getitem__)] = np.arange(len(item))
    order = np.lexsort((name, lang_count, -count))
    kept = np.empty(len(item), np.int64)
    low, early, n = np.empty(len(item), np.int64), np.empty(len(item), np.int64), 0
    for i in order.tolist():
        if n < k or np.count_nonzero((low[:n] <= lang_count[i]) & (early[:n] < name[i])) < k:
            kept[n], low[n], early[n] = i, lang_count[i], name[i]
            n += 1
    return kept[:n]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences and documents of each group's terms, summed over many texts first."""
    n, held, most = defaultdict(Counter), defaultdict(Counter), 0

    def rows() -> pd.DataFrame:  # column by column; the terms of a group are decoded at once
        out = {c: [] for c in ("lang", "source", "term", "n", "docs")}
        for (lang, source), found in n.items():
            out["lang"] += [lang] * len(found)
            out["source"] += [source] * len(found)
            out["term"] += b" ".join(found).decode("utf-8", "replace").split(" ") if found else []
            out["n"] += found.values()
            out["docs"] += map(held[lang, source].__getitem__, found)
        n.clear(), held.clear()
        return pd.DataFrame({c: pd.Series(v, dtype="int64" if c in ("n", "docs") else "object") for c, v in out.items()})

    for pdf in batches:
        for lang, source, text in zip(pdf["lang"], pdf["source"], pdf["_text"], strict=True):
            terms = text.encode("utf-8", "replace").translate(TERM_BYTES).split()
            n[lang, source].update(terms)
            held[lang, source].update(once := set(terms))
            most += len(once)  # of the terms that are held, until they are counted
            if most >= TASK_TERMS and (most := sum(map(len, n.values()))) >= TASK_TERMS:
                yield rows()
                most = 0
    yield rows()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it)."""
    some = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "_text"))])
    counted = some.transform(map_batches, _counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms: str) -> str:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in whole numbers."""
    return f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + {PRIOR} as decimal(20,0))) div cast({total} + {PRIOR} * {terms} as decimal(20,0))"


def _distances(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Of one block of a language's terms: for all pairs of its sources, the sum of the
    differences of their shares.  ``left``: source, term, p of terms that occur; ``right``:
    every source with its share of a term that doesn't occur."""
    right = right.sort_values("source").reset_index(drop=True)
    sources = right["source"].to_numpy()
    column, terms = pd.factorize(left["term"])
    row = pd.Index(sources).get_indexer(left["source"])
    p = np.repeat(right["p0"].fillna(0).to_numpy(np.int64)[:, None], len(terms), axis=1)
    p[row, column] = left["p"].to_numpy(np.int64)
    lang, out = right["lang"].iloc[0] if len(right) else "", []
    for a in range(len(sources)):
        apart = np.abs(p - p[a]).sum(1)
        others = np.arange(len(sources)) != a
        out.append(pd.DataFrame({"lang": lang, "source": sources[a], "item": sources[others], "value": apart[others].astype(np.int64)}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"lang": [], "source": [], "item": [], "value": []})


def _band_of(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[skyband(pdf["n"].to_numpy(np.int64), pdf["lang_n"].to_numpy(np.int64), pdf["term"].tolist(), k)]

    return run


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part (pair or term), item, value, rank.

    Part pair ranks, for each source of a language, all its other sources by distance; part
    term ranks a source's terms with a share above the language's, the first ``top``.  Null
    text, language and source count as empty; documents without terms still make their
    source occur; a language without kept terms has distances of 0.  Repeated rows and
    equal ids are documents of their own.  A language with one source has no pairs; an
    empty table has no rows."""
    let_workers_import(docs.sparkSession)
    counts = cut(term_counts(docs, text, lang, source))
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("_d")).where(f"_d >= {least_docs}")
    kept = cut(kept.select(F.col("lang").alias("_l"), F.col("term").alias("_t"), "lang_n"))
    mine = cut(counts.join(kept, (F.col("lang") == F.col("_l")) & (F.col("term") == F.col("_t"))).select("lang", "source", "term", "n", "lang_n"))

    groups = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    sums = mine.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.sum("n").alias("_n"))
    langs = kept.groupBy(F.col("_l").alias("_l2")).agg(F.sum("lang_n").alias("_ln"), F.count(F.lit(1)).alias("_v"))
    groups = groups.join(sums, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left").join(langs, F.col("lang") == F.col("_l2"), "left")
    groups = cut(groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("_n", "_ln", "_v")]).withColumn("p0", F.expr(f"case when _v > 0 then {_share('0', '_n', '_v')} end")))
    widest = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("_v").alias("v")).agg(F.max("s").alias("s"), F.max("v").alias("v")).first()
    block = max(16, min(BLOCK_TERMS, BLOCK_CELLS // max(1, widest["s"] or 1)))

    g = groups.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "_n", "_ln", "_v")
    shares = mine.join(g, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s"))).select(
        "lang", "source", "term", "n", "lang_n", "_v", F.expr(_share("n", "_n", "_v")).alias("p"), F.expr(_share("lang_n", "_ln", "_v")).alias("q")
    )
    blocks = f"greatest(1L, ceil(_v / {block}))"
    dealt = shares.select("lang", F.expr(f"pmod(xxhash64(term), {blocks})").alias("_b"), "source", "term", "p")
    all_groups = groups.select("lang", F.expr(f"explode(sequence(0L, {blocks} - 1))").alias("_b"), "source", "p0")
    apart = dealt.groupBy("lang", "_b").cogroup(all_groups.groupBy("lang", "_b")).applyInPandas(_distances, "lang string, source string, item string, value long")
    pairs = apart.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    band = shares.where("p > q").select("lang", "source", "term", "n", "lang_n", (F.col("p") - F.col("q")).alias("value"))
    parts = max(1, ceil((widest["v"] or 0) / PART_TERMS))
    band = band.withColumn("_part", F.expr(f"pmod(xxhash64(term), {parts})"))
    while True:
        band = band.groupBy("lang", "source", "_part").applyInPandas(_band_of(top), band.schema)
        if parts == 1:
            break
        parts = ceil(parts / FAN_IN)
        band = band.withColumn("_part", F.expr(f"_part div {FAN_IN}"))

    first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(first))
    pairs = ranked(pairs).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    terms = ranked(band.select("lang", "source", F.col("term").alias("item"), "value")).where(f"rank <= {top}")
    return pairs.unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


#: DuckDB SQL for audit_sources() with its defaults over documents.
AUDIT_SQL = f"""
with d as (
    select coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
    from documents
), words as (
    select lang, source, unnest(terms) as term from d
), held as (
    select lang, term, count(*) as docs from (select lang, unnest(list_distinct(terms)) as term from d) group by lang, term
), kept as (
    select lang, term from held where docs >= {LEAST_DOCS}
), grp as (
    select distinct lang, source from d
), n_all as (
    select w.lang, w.source, w.term, count(*) as n from words w join kept using (lang, term) group by w.lang, w.source, w.term
), n_lang as (
    select lang, term, sum(n) as n from n_all group by lang, term
), v as (
    select lang, count(*) as v, sum(n) as total from n_lang group by lang
), totals as (
    select g.lang, g.source, coalesce(sum(n.n), 0) as total from grp g left join n_all n on n.lang = g.lang and n.source = g.source group by g.lang, g.source
), dense as (
    select g.lang, g.source, k.term, coalesce(n.n, 0) as n,
           (1 + ({SCALE}::hugeint * (coalesce(n.n, 0) + {PRIOR})) // (t.total + {PRIOR} * v.v))::bigint as p
    from grp g join kept k on k.lang = g.lang join v on v.lang = g.lang join totals t on t.lang = g.lang and t.source = g.source
    left join n_all n on n.lang = g.lang and n.source = g.source and n.term = k.term
), shares as (
    select l.lang, l.term, (1 + ({SCALE}::hugeint * (l.n + {PRIOR})) // (v.total + {PRIOR} * v.v))::bigint as q from n_lang l join v on v.lang = l.lang
), pairs as (
    select a.lang, a.source, b.source as item,
           coalesce((select sum(abs(x.p - y.p)) from dense x join dense y on x.lang = y.lang and x.term = y.term
                     where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
    from grp a join grp b on a.lang = b.lang and a.source <> b.source
), above as (
    select x.lang, x.source, x.term as item, x.p - s.q as value from dense x join shares s on x.lang = s.lang and x.term = s.term where x.n > 0 and x.p > s.q
)
select lang, source, 'pair' as part, item, value, (row_number() over (partition by lang, source order by value desc, item))::int as rank from pairs
union all
select * from (
    select lang, source, 'term' as part, item, value, (row_number() over (partition by lang, source order by value desc, item))::int as rank from above
) where rank <= {TOP}
"""
