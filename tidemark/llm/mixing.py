"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its share of the byte budget over its own
bytes.  Each document's number of copies is the Poisson quantile, for that mean, of a
uniform number hashed from its id, so that a rerun draws the same copies; the copies
are exploded and shuffled globally by a second hash.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Rates of up to this many sources (600 bytes each) are broadcast; those of more are joined
#: with documents that are dealt by so many salts.
MOST_BROADCAST, SALTS = 10_000, 64
#: A mean above this is drawn as a sum of equal Poisson parts, each of a mean up to this.
PART_MEAN = 16
#: Terms of a part's distribution; the tail beyond them is below 1e-20 at PART_MEAN.
TERMS = 72


def _uniform(key: str) -> str:
    """A double in [0, 1) from 52 bits of the key's md5."""
    return f"cast(conv(substr(md5({key}), 1, 13), 16, 10) as double) / 4503599627370496D"


def source_rates(docs: DataFrame, weights: dict | None = None, budget_bytes: int | None = None, source: str = "source", text: str = "text") -> DataFrame:
    """One row per source (a null source is one of them): mean rate and the cumulative
    Poisson distribution of one part.

    ``weights`` maps source to target weight (absent: 0; the key None is the null source).
    Without it, weights are the square roots of the sources' bytes, which lifts small
    sources.  ``budget_bytes`` is the expected size of the mix (without it: that of the
    input).  A source without bytes has rate 1."""
    sizes = cut(
        docs.groupBy(F.col(source).alias("__source")).agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long")).alias("bytes"))
    )
    if weights is None:
        sizes = sizes.withColumn("weight", F.sqrt("bytes"))
    else:
        given = [x for k, v in weights.items() if k is not None for x in (F.lit(k), F.lit(float(v)))]
        known = F.element_at(F.create_map(*given), F.col("__source")) if given else F.lit(None).cast("double")
        sizes = sizes.withColumn("weight", F.coalesce(F.when(F.col("__source").isNull(), F.lit(float(weights.get(None, 0)))).otherwise(known), F.lit(0.0)))
    total = sizes.agg(F.sum("bytes").alias("b"), F.sum("weight").alias("w")).first()
    budget, weight = float(budget_bytes if budget_bytes is not None else total["b"] or 0), float(total["w"] or 0) or 1.0
    return (
        sizes.withColumn("__rate", F.expr(f"case when bytes = 0 then 1D else weight / {weight!r}D * {budget!r}D / bytes end"))
        .withColumn("__parts", F.greatest(F.lit(1), F.ceil(F.col("__rate") / PART_MEAN)).cast("int"))
        .withColumn("_mean", F.expr("__rate / __parts"))
        .withColumn(
            "__cdf",
            F.expr(
                f"""aggregate(sequence(1, {TERMS}),
                    named_struct('p', exp(-_mean), 'sum', exp(-_mean), 'all', array(exp(-_mean))),
                    (a, k) -> named_struct('p', a.p * _mean / k, 'sum', a.sum + a.p * _mean / k,
                                           'all', array_append(a.all, a.sum + a.p * _mean / k)),
                    a -> a.all)"""
            ),
        )
        .drop("_mean")
    )


def mix(docs: DataFrame, weights: dict | None = None, budget_bytes: int | None = None, seed: str = "mix-1", id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """All columns of ``docs``, one row per copy, plus ``n_copies``, ``copy_no`` (from 0),
    ``rate_millionths`` and ``shuffle_key``; range-partitioned and sorted by the key.

    A document without an id draws by its text's md5.  Rows with equal ids draw equal
    counts.  Null or empty texts cost no bytes and are drawn like the others.  Columns
    of ``docs`` that bear the names added here are replaced."""
    docs = docs.drop("n_copies", "copy_no", "rate_millionths", "shuffle_key")
    rates = cut(source_rates(docs, weights, budget_bytes, source, text).select("__source", "__rate", "__parts", "__cdf"))
    if rates.count() <= MOST_BROADCAST:
        rated = docs.join(F.broadcast(rates), docs[source].eqNullSafe(rates["__source"]))
    else:  # salted, so that a hot source's documents are dealt to many tasks
        salted = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = docs.withColumn("__of", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        rated = dealt.join(salted, dealt[source].eqNullSafe(salted["__source"]) & (dealt["__of"] == salted["__salt"])).drop("__of", "__salt")
    key = f"coalesce(cast(`{id_col}` as string), concat('text ', md5(coalesce(`{text}`, ''))))"
    drawn = rated.withColumn(
        "n_copies",
        F.expr(
            f"""aggregate(transform(sequence(1, __parts), j -> {_uniform(f"concat('{seed}|', {key}, '|', j)")}), 0,
                (n, u) -> n + size(filter(__cdf, c -> c <= u)))"""
        ),
    )
    copies = (
        drawn.where("n_copies > 0")
        .withColumn("rate_millionths", F.floor(F.col("__rate") * 1_000_000))
        .drop("__source", "__rate", "__parts", "__cdf")
        .withColumn("copy_no", F.expr("explode(sequence(0, n_copies - 1))"))
        .withColumn("shuffle_key", F.expr(f"cast(conv(substr(md5(concat('{seed}|order|', {key}, '|', copy_no)), 1, 15), 16, 10) as bigint)"))
    )
    return copies.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key")


#: DuckDB SQL for mix() with its defaults over documents.
MIX_SQL = f"""
with recursive sizes as (
    select source, sum(coalesce(strlen(text), 0))::bigint as bytes from documents group by source
), totals as (
    select sum(bytes)::double as b, sum(sqrt(bytes::double)) as w from sizes
), rates as (
    select source, case when bytes = 0 then 1.0::double else sqrt(bytes::double) / w * b / bytes end as rate from sizes, totals
), parted as (
    select source, rate, greatest(1, ceil(rate / {PART_MEAN}))::int as parts from rates
), cdf(source, k, mean, p, c) as (
    select source, 0, rate / parts, exp(-(rate / parts)), exp(-(rate / parts)) from parted
    union all
    select source, k + 1, mean, p * mean / (k + 1), c + p * mean / (k + 1) from cdf where k < {TERMS}
), numbered as (
    select *, row_number() over () as row_no from documents
), draws as (
    select d.row_no, d.doc_id, d.source, d.lang, d.text, d.n_chars, r.rate, coalesce(d.doc_id::varchar, 'text ' || md5(coalesce(d.text, ''))) as key,
           unnest(generate_series(1, r.parts)) as j
    from numbered d join parted r on d.source is not distinct from r.source
), counted as (
    select d.*, (select count(*) from cdf c where c.source is not distinct from d.source
                 and c.c <= ('0x' || substr(md5('mix-1|' || d.key || '|' || d.j), 1, 13))::bigint::double / 4503599627370496) as n
    from draws d
), copies as (
    select any_value(doc_id) as doc_id, any_value(text) as text, any_value(lang) as lang, any_value(source) as source,
           any_value(n_chars) as n_chars, any_value(rate) as rate, any_value(key) as key, sum(n)::int as n_copies
    from counted group by row_no
)
select doc_id, text, lang, source, n_chars, n_copies, copy_no::int as copy_no, floor(rate * 1000000)::bigint as rate_millionths,
       ('0x' || substr(md5('mix-1|order|' || key || '|' || copy_no), 1, 15))::bigint as shuffle_key
from (select *, unnest(generate_series(0, n_copies - 1)) as copy_no from copies where n_copies > 0)
"""
