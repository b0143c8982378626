"""Quality rules as a short-circuit cascade: a sample gives each rule's cost and rejection, the order follows.

DataFrame functions only. The conditions are branches of one CASE expression, so a text that an early rule
rejects is never given to the later ones; a measure that only a rule needs is computed inside its branch.
The order never changes which documents are kept, only what is spent on a bad one.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import let, text_of, unnested

#: 3-word windows with their starts; equal ones are side by side after sorting. A repeated window adds the words
#: up to the next repeated one's start, three at most.
_NONE = "cast(array() as array<struct<w:string,i:int>>)"
_WINDOWS = f"case when size(ws) > 2 then transform(slice(ws, 1, size(ws) - 2), (w, i) -> struct(w || ' ' || ws[i + 1] || ' ' || ws[i + 2] as w, i as i)) else {_NONE} end"
_SORTED = f"case when size(array_distinct(transform(win, x -> x.w))) < size(win) then sort_array(win) else {_NONE} end"
_AGAIN = """sort_array(transform(filter(transform(srt, (x, k) -> struct(x.i as i,
    (k > 0 and get(srt, k - 1).w = x.w) or coalesce(get(srt, k + 1).w = x.w, false) as twice)), x -> x.twice), x -> x.i))"""
_SUM = "aggregate(transform(again, (x, k) -> least(3, coalesce(get(again, k + 1) - x, 3))), 0L, (a, x) -> a + x)"
REPEATS = let("ws", "words_", let("win", _WINDOWS, let("srt", _SORTED, let("again", _AGAIN, _SUM))))


_WORDS = r"filter(split(text_, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"
_LINES = r"filter(split(text_, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"
#: SQL of each measure over text_ alone.
MEASURES = {
    "n_words": f"cast(size({_WORDS}) as long)",
    "word_chars": r"cast(length(regexp_replace(text_, '[\\x20\\x09-\\x0D]+', '')) as long)",
    "n_symbols": "cast(length(text_) - length(translate(text_, '#*$%&|<>', '')) as long)",
    "n_dup_lines": let("ls", _LINES, "cast(size(ls) - size(array_distinct(ls)) as long)"),
    "n_repeat_words": let("words_", _WORDS, REPEATS),
}


def measures(docs: DataFrame) -> DataFrame:
    """docs plus text_ (null: empty) and the measures."""
    df = docs.withColumn("text_", text_of("text"))
    df = df.withColumn("words_", F.expr(_WORDS)).withColumn("n_words", F.size("words_").cast("long"))
    for name in ("word_chars", "n_symbols", "n_dup_lines"):
        df = df.withColumn(name, F.expr(MEASURES[name]))
    return df.withColumn("n_repeat_words", F.expr(REPEATS)).drop("words_")


@dataclass(frozen=True)
class Rule:
    """A name and the SQL condition that rejects a text, over text_ and the measures."""

    name: str
    rejects: str

    def column(self, computed: tuple[str, ...]) -> Column:
        """The condition, with the measures that are not yet columns put in as expressions."""
        sql = self.rejects
        for name, measure in MEASURES.items():
            if name not in computed:
                sql = sql.replace(name, f"({measure})")
        return F.expr(sql)


#: What the contract calls base; always judged.
BASE = [Rule("few_words", "n_words < 50"), Rule("mostly_repeats", "100 * n_repeat_words > 50 * n_words")]


def rules() -> list[Rule]:
    """The verdict's own rules, beyond the base ones."""
    n = "greatest(n_words, 1)"
    return [
        Rule("symbols", f"n_symbols > 0.3D * {n}"),
        Rule("word_length", f"word_chars < 2 * {n} or word_chars > 20 * {n}"),
        Rule("duplicate_lines", r"n_dup_lines > 0.3D * (length(text_) - length(translate(text_, '\n', '')) + 1)"),
        Rule("shouting", "length(regexp_replace(text_, '[^A-Z]+', '')) > 0.5D * word_chars"),
        Rule("exclamations", f"length(text_) - length(translate(text_, '!', '')) > 0.3D * {n}"),
        Rule("letters", r"length(regexp_replace(text_, '[^\\p{L}]+', '')) < 0.6D * word_chars"),
        Rule("repeats", f"n_repeat_words > 0.3D * {n}"),
    ]


def ordered(docs: DataFrame, found: list[Rule], computed: tuple[str, ...] = (), sample: int = 500, repeats: int = 4) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, share rejected), the most rejected per second first.

    The sample is the ``sample`` distinct texts with the least hashes, whatever their places in the table; only
    hashes are sorted. Each rule is
    evaluated alone on it, ``repeats`` times a row and in two runs of which the faster counts, less what reading
    the rows takes. Costs are taken to the next power of two, so that noise seldom changes an order; ties by name.
    ``computed`` are the measures that are columns at no cost of the rule.
    """
    hashed = docs.select("text", F.xxhash64("text").alias("hash_"))
    upto = hashed.groupBy("hash_").agg(F.lit(1)).orderBy("hash_").limit(sample).agg(F.max("hash_")).first()[0]
    rows = hashed.where(F.col("hash_") <= F.lit(upto).cast("long")).dropDuplicates(["hash_"])
    rows = measures(rows.select("text")).cache()
    total = max(1, rows.count())
    many = rows.withColumn("again_", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def run(condition: Column) -> tuple[float, int]:
        best, hit = math.inf, 0
        for _ in range(2):
            began = time.perf_counter()
            hit = many.agg(F.count_if(condition)).first()[0]
            best = min(best, time.perf_counter() - began)
        return best, hit

    empty, _ = run(F.col("again_") < 0)
    figures = []
    for rule in found:
        took, hit = run(rule.column(computed))
        cost = max(1e-8, (took - empty) / (total * repeats))
        figures.append((rule, 2.0 ** math.ceil(math.log2(cost)), hit / (total * repeats)))
    rows.unpersist()
    return sorted(figures, key=lambda x: (-x[2] / x[1], x[0].name))


def _chain(order: list[Rule], computed: tuple[str, ...]) -> Column:
    """The name of the first rule that rejects, null where none does."""
    chain = F.when(order[0].column(computed), order[0].name)
    for rule in order[1:]:
        chain = chain.when(rule.column(computed), rule.name)
    return chain


def apply(docs: DataFrame, sample: int = 500) -> DataFrame:
    """docs plus the measures, base_failed, kept, and rejected_by: the first rule of the cascade that rejects.

    A null text is empty: no words, so it fails the base rules. Texts are measured whole. Repeated rows and null
    ids stay. Columns of the input with the names of results are replaced; an empty table gives no rows. Which
    of several rejecting rules is named follows the order of the cascade; the verdict does not.
    """
    computed = tuple(MEASURES)
    cascade = [r for r, _, _ in ordered(docs, rules(), computed, sample)]
    df = measures(docs)
    df = df.withColumn("base_failed", BASE[0].column(computed) | BASE[1].column(computed))
    chain = F.when(F.col("base_failed"), "base").otherwise(_chain(cascade, computed))
    return df.withColumn("rejected_by", chain).withColumn("kept", F.col("rejected_by").isNull()).drop("text_")


def keep(docs: DataFrame, sample: int = 500) -> DataFrame:
    """The rows that no rule rejects, base ones included, with all their columns, whatever their names.

    Here nothing but the number of words is measured ahead: the dear measures are computed only for texts that
    the rules before them let pass. Null texts are rejected; repeated rows are judged alike.
    """
    computed = ("n_words",)
    cascade = [r for r, _, _ in ordered(docs, [*BASE, *rules()], computed, sample)]
    df = docs.select(F.struct("*").alias("row"), text_of("text").alias("text_"))
    df = df.withColumn("n_words", F.expr(MEASURES["n_words"])).where(_chain(cascade, computed).isNull())
    return unnested(df, docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op9."""
    return apply(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
with w as (select doc_id, coalesce(text, '') as t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
g as (select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as v from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, v) as n from g) where n > 1),
c as (select doc_id, count(distinct i + k) as n from r, (select unnest([0, 1, 2]) as k) group by doc_id),
m as (select w.doc_id, len(words) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as n_dup_lines,
  coalesce(c.n, 0) as n_repeat_words, length(t) - length(translate(t, chr(10), '')) + 1 as n_lines, length(regexp_replace(t, '[^A-Z]+', '', 'g')) as n_upper,
  length(t) - length(translate(t, '!', '')) as n_bangs, length(regexp_replace(t, '[^\p{L}]+', '', 'g')) as n_letters from w left join c using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, greatest(n_words, 1) as n1 from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not (base_failed or n_symbols > 0.3 * n1 or word_chars < 2 * n1 or word_chars > 20 * n1 or n_dup_lines > 0.3 * n_lines or n_upper > 0.5 * word_chars or n_bangs > 0.3 * n1
       or n_letters < 0.6 * word_chars or n_repeat_words > 0.3 * n1) as kept from b
"""
