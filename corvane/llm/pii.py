"""Personal data by candidates and gradient boosting, in DataFrame functions only.

Base spans (email, ip, card, phone) follow fixed patterns and always stay. Wide generators propose further,
overlapping spans: digit groups that may be a phone, national numbers, bank accounts, spelled-out mail
addresses, birth dates, opaque strings that may be a secret. Boosted trees score each by its format and by the
words around it; a threshold calibrated for each kind on rows left out of the fit selects those to redact. The
trees are fitted on a labelled table that ``corvane.llm.pii_table`` writes from templates, and become one SQL expression.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import let, text_of, unnested
from corvane.llm.pii_table import labelled

MARK = "\x01"
#: Overwrites base spans where candidates are sought.
MASK = "\x03"
#: Base patterns. A run of the first class is only tried at its start or where the last match ended, and takes
#: all it can at once: the matches are those of the plain patterns, in time linear in the text.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators of further candidates: wide, so that the trees decide.
MORE = {
    "local_phone": r"(?<![0-9A-Za-z+.,/-])\(?[0-9]{2,5}\)?(?:[ ./-]{1,2}[0-9]{2,7}){1,5}+(?![0-9A-Za-z]|[.,/-][0-9])",
    "national_id": r"(?<![0-9A-Za-z.,/-])(?:[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}|[0-9]{8}-?[A-Z]|[12] ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[0-9]{3} ?[0-9]{3}(?: ?[0-9]{2})?|[0-9]{2} ?[0-9]{6} ?[A-Z] ?[0-9]{3})(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "spelled_email": r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]++)+",
    "birth_date": r"(?<![0-9A-Za-z.,/-])(?:(?:[0-9]{1,2}[.][0-9]{1,2}[.]|[0-9]{1,2}/[0-9]{1,2}/|[0-9]{1,2}-[0-9]{1,2}-)(?:[0-9]{4}|[0-9]{2})|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9A-Za-z]|[./-][0-9])",
    "secret": r"(?<![A-Za-z0-9_+/=.-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{10,}+(?:\.[A-Za-z0-9_+/-]{10,}+)*+={0,2}(?![A-Za-z0-9_+/=@-])",
}
KINDS = [*BASE, *MORE]
#: What a text must hold for a pattern to match at all: a cheap look that spares most texts the patterns.
GATES = {
    "email": "contains(text_, '@')",
    "phone": "contains(text_, '+') and text_ rlike '[+][0-9]'",
    "spelled_email": r"text_ rlike '[\\[(] ?at ?[\\])]'",
    "iban": "text_ rlike '[A-Z]{2}[0-9]{2}'",
    "secret": "text_ rlike '[A-Za-z0-9_+/-]{10}' and text_ rlike '[0-9]'",
}
DIGIT = "text_ rlike '[0-9]'"
CONTEXT = 32
#: Words that speak for a kind, or against any, in the four languages of the labelled table.
HINTS = {
    "phone": r"(?i)(phone|\\btel\\b|t[eé]l\\.|tel[eé]f|t[eé]l[eé]ph|\\bcall|\\bfax|mobile|m[oó]vil|\\bcell|handy|anruf|ruf(en|t)? |appel|llam|whatsapp|\\btext (me|us)|reach)",
    "identity": r"(?i)(ssn|social|\\bsteuer|ausweis|tax ?id|passport|identit|\\bdni\\b|\\bnif\\b|national|s[eé]curit[eé]|seguridad|sozialvers)",
    "bank": r"(?i)(iban|bank|account|konto|compte|cuenta|transfer|[uü]berweis|vire)",
    "mail": r"(?i)(e-?mail|\\bmail|write|contact|schreib|[eé]cri|escrib|courriel|correo|reach)",
    "birth": r"(?i)(born|birth|\\bdob\\b|geb(oren|urtsdatum|\\.)|n[eé]e? le|naissance|nacid|nacimiento)",
    "key": r"(?i)(token|secret|passw|\\bpwd\\b|kennwort|contrase|mot de passe|api.?key|[_-]key|\\bkey\\b|auth|bearer|credential|login)",
    "code": r"(?i)(order|invoice|part|sku|model|\\bref|version|isbn|\\bid\\b|no\\.|total|line|page|serial|track|commit|sha|md5|checksum|hash|http|www|rows?|bestell|rechnung|seite|facture|commande|pedido|factura|file|path|build|released?|since|between|from|sum)[^A-Za-z]{0,4}$",
    "unit": r"(?i)^ ?(%|units?|pieces?|st[uü]ck|euros?|usd|dollars?|km|kg|bytes|rows|items|times|pages|years|people|and more|in all|each|were|was sent|\\.(html?|png|jpg|pdf|txt|js))",
}
#: SQL of each feature over the candidate x.
FEATURES = {
    "kind": f"array_position(array({', '.join(map(repr, MORE))}), x.kind)",
    "length": "length(x.m)",
    "digits": "length(regexp_replace(x.m, '[^0-9]+', ''))",
    "upper": "length(regexp_replace(x.m, '[^A-Z]+', ''))",
    "lower": "length(regexp_replace(x.m, '[^a-z]+', ''))",
    "groups": "size(split(x.m, '[^0-9A-Za-z]+'))",
    "brackets": r"int(x.m rlike '^[(][0-9]+[)]')",
    "zero": "int(x.m rlike '^[(]?0')",
    "round": "int(x.m rlike '00$')",
    "dots": "length(x.m) - length(replace(x.m, '.', ''))",
    "slashes": "length(x.m) - length(replace(x.m, '/', ''))",
    "spaces": "length(x.m) - length(replace(x.m, ' ', ''))",
    "tight": r"int(x.m rlike '[A-Za-z0-9][.][A-Za-z0-9]|[dD][oO][tT] ?[)\\]]')",
    "last": "length(regexp_extract(x.m, '([0-9A-Za-z]+)[^0-9A-Za-z]*$', 1))",
    "switches": "size(split(x.m, '(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])'))",
    "quoted": """int(x.before rlike '[:=] ?["\\']?$')""",
    **{n: f"int(x.before rlike '{p}')" for n, p in HINTS.items() if n != "unit"},
    "unit": f"int(x.after rlike '{HINTS['unit']}')",
    "phone_after": f"int(x.after rlike '{HINTS['phone']}')",
}


def fit_tree(x: np.ndarray, codes: np.ndarray, grad: np.ndarray, weight: np.ndarray, depth: int) -> tuple:
    """A regression tree on the gradients, with Newton steps at its leaves: (feature, cut, low, high) or (value,).

    ``codes`` are the ranks of the values of ``x`` by feature.
    """
    total, whole = grad.sum(), weight.sum() + 1.0
    best, found = total**2 / whole + 1e-6, None
    for j in range(x.shape[1]) if depth else ():
        g, w, n = np.cumsum(np.bincount(codes[:, j], grad)), np.cumsum(np.bincount(codes[:, j], weight)), np.cumsum(np.bincount(codes[:, j]))
        gain = np.where((n > 0) & (n < len(x)), g**2 / (w + 1.0) + (total - g) ** 2 / (whole - w), 0.0)
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, found = float(gain[k]), (j, float(x[codes[:, j] <= k, j].max()))
    if found is None:
        return (float(total / whole),)
    low = x[:, found[0]] <= found[1]
    return (*found, fit_tree(x[low], codes[low], grad[low], weight[low], depth - 1), fit_tree(x[~low], codes[~low], grad[~low], weight[~low], depth - 1))


def values_of(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    return np.where(x[:, tree[0]] <= tree[1], values_of(tree[2], x), values_of(tree[3], x))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 25, rate: float = 0.3, depth: int = 4) -> list[tuple]:
    """Gradient boosting of the logistic loss; the leaves hold the rate already."""
    total, trees = np.zeros(len(y)), []
    codes = np.column_stack([np.unique(c, return_inverse=True)[1] for c in x.T])
    scaled = lambda t: (t[0] * rate,) if len(t) == 1 else (t[0], t[1], scaled(t[2]), scaled(t[3]))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        trees.append(scaled(fit_tree(x, codes, y - p, p * (1 - p), depth)))
        total = total + values_of(trees[-1], x)
    return trees


def scores(trees: list[tuple], x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-sum(values_of(t, x) for t in trees)))


def _sql(tree: tuple) -> str:
    if len(tree) == 1:
        return f"{tree[0]:.6f}D"
    return f"(case when f.{list(FEATURES)[tree[0]]} <= {tree[1]} then {_sql(tree[2])} else {_sql(tree[3])} end)"


def threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F-half on rows that the fit has not seen (precision counts more than recall), midway to the next score."""
    order = np.argsort(-score, kind="stable")
    hit = np.cumsum(y[order])
    precision, recall = hit / np.arange(1, len(y) + 1), hit / max(1, y.sum())
    k = int(np.argmax(1.25 * precision * recall / np.maximum(0.25 * precision + recall, 1e-9)))
    below = score[order[k + 1]] if k + 1 < len(order) else 0.0
    return float(min(0.95, max(0.05, (score[order[k]] + below) / 2)))


def feature_rows(spark: SparkSession, rows: list[tuple]) -> np.ndarray:
    """The features of (kind, candidate, before, after, label) rows, in the order of FEATURES."""
    df = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(rows)], "i int, kind string, m string, before string, after string")
    df = df.select("i", F.struct("kind", "m", "before", "after").alias("x"))
    got = sorted(df.selectExpr("i", *[f"{s} as f_{n}" for n, s in FEATURES.items()]).collect())
    return np.array([[float(v) for v in r[1:]] for r in got])


_FITTED: dict[str, tuple[str, dict[str, float]]] = {}


def fitted(spark: SparkSession) -> tuple[str, dict[str, float]]:
    """(SQL of the score from the struct f, threshold by kind), from the labelled table; thresholds by five folds."""
    if "all" not in _FITTED:
        rows = labelled()
        x, y, kinds = feature_rows(spark, rows), np.array([r[4] for r in rows], float), np.array([r[0] for r in rows])
        fold = np.arange(len(y)) % 5
        left_out = np.zeros(len(y))
        for k in range(5):
            left_out[fold == k] = scores(boost(x[fold != k], y[fold != k]), x[fold == k])
        limits = {kind: threshold(left_out[kinds == kind], y[kinds == kind]) for kind in MORE}
        total = " + ".join(_sql(t) for t in boost(x, y))
        _FITTED["all"] = f"1 / (1 + exp(-({total})))", limits
    return _FITTED["all"]


CANDIDATE = "struct<start:int,end:int,kind:string,p:double>"
SPAN = "struct<kind:string,start:int,end:int,m:string,before:string,after:string>"


def fold(n: str, of: str, at: str, step: Callable[[str, str], tuple[str, str]], chunk: int = 64, finish: str = "flatten(o.parts)", near: str = "0") -> str:
    """SQL of a running fold over 0 .. n - 1 that starts from ``at`` and gathers an array ``of`` elements.

    ``step`` gives the next state and an array of new elements from the state and the index. Elements are gathered
    in chunks and the chunks then, so that an array of many is not copied for each. ``near`` is bound once for a chunk: what its
    steps look at, from the chunk's first state ``o.at`` and its last index ``last``.
    """
    inner_at, inner = step("s.at", "i")
    one = f"""aggregate(sequence(c * {chunk}, last), named_struct('at', o.at, 'found', cast(array() as array<{of}>)),
        (s, i) -> named_struct('at', {inner_at}, 'found', concat(s.found, {inner})))"""
    return f"""aggregate(sequence(0, ({n} - 1) div {chunk}), named_struct('at', {at}, 'parts', cast(array() as array<array<{of}>>)),
        (o, c) -> {let('last', f'least(c * {chunk} + {chunk - 1}, {n} - 1)', let('near', near, let('got', one, "named_struct('at', got.at, 'parts', concat(o.parts, array(got.found)))")))}, o -> {finish})"""


def _spans_sql(kind: str) -> str:
    """Array of spans from the pieces ``ps`` between marks; odd pieces are the matches."""

    def step(at: str, i: str) -> tuple[str, str]:
        gap, hit = f"ps[2 * {i}]", f"ps[2 * {i} + 1]"
        span = f"named_struct('kind', '{kind}', 'start', {at} + length({gap}), 'end', {at} + length({gap}) + length({hit}), 'm', {hit}, 'before', right({gap}, {CONTEXT}), 'after', left(ps[2 * {i} + 2], {CONTEXT}))"
        return f"{at} + length({gap}) + length({hit})", f"array({span})"

    return fold("int(size(ps) div 2)", SPAN, "0", step)


def _matches(df: DataFrame, kind: str, pattern: str) -> DataFrame:
    """df plus a column of that kind's raw matches; texts that cannot hold one, or hold none, are not split."""
    df = df.withColumn("marked", F.when(F.expr(GATES.get(kind, DIGIT)), F.regexp_replace("text_", f"({pattern})", f"{MARK}$1{MARK}")))
    df = df.withColumn("pieces", F.when(F.length("marked") > F.length("text_"), F.split("marked", MARK, -1)))
    return df.withColumn(kind, F.expr(f"case when pieces is null then cast(array() as array<{SPAN}>) else {let('ps', 'pieces', _spans_sql(kind))} end")).drop("marked", "pieces")


DIGITS = "regexp_replace(x.m, '[^0-9]+', '')"
LUHN = f"""aggregate(sequence(1, length({DIGITS})), 0, (s, i) -> s + case when i % 2 = 1 then int(substr(reverse({DIGITS}), i, 1))
    else int(substr(reverse({DIGITS}), i, 1)) * 2 - if(int(substr(reverse({DIGITS}), i, 1)) > 4, 9, 0) end) % 10 = 0"""
#: What a raw match must also satisfy; failing ones are dropped.
VALID = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(cast(nullif(ltrim('0', p), '') as int), 0) <= 255)",
    "card": f"length({DIGITS}) between 12 and 19 and {LUHN}",
    "phone": f"length({DIGITS}) between 9 and 15",
    # further candidates: forms that are never that kind
    "local_phone": f"length({DIGITS}) between 8 and 12",
    "secret": "x.m rlike '[0-9]' and x.m rlike '[A-Za-z]'",
}


def _found(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), base, spans."""
    score, limits = fitted(docs.sparkSession)
    df = docs.select(F.struct("*").alias("row"), F.translate(text_of("text"), MARK, "\x02").alias("text_"))
    for kind, pattern in BASE.items():
        df = _matches(df, kind, pattern)
    order = f"array_position(array({', '.join(map(repr, KINDS))}), x.kind)"
    shape = f"named_struct('start', x.start, 'order', int({order}), 'kind', x.kind, 'end', x.end)"
    base = ", ".join(f"filter({k}, x -> {VALID[k]})" for k in BASE)
    df = df.withColumn("base", F.expr(f"array_sort(transform(concat({base}), x -> {shape}))")).drop(*BASE)
    # candidates are sought in the text beside the base spans
    df = df.withColumn("text_", F.expr(f"case when size(base) = 0 then text_ else {let('sp', 'base', let('raw', 'text_', MASKED))} end"))
    for kind, pattern in MORE.items():
        df = _matches(df, kind, pattern)
    more = ", ".join(f"filter({k}, x -> {VALID[k]})" if k in VALID else k for k in MORE)
    given = ", ".join(f"'{n}', {s}" for n, s in FEATURES.items())
    df = df.withColumn("more_", F.expr(f"transform(concat({more}), x -> named_struct('x', x, 'f', named_struct({given})))"))
    limit = " ".join(f"when x.kind = '{k}' then {v:.6f}D" for k, v in limits.items())
    scored = f"transform(more_, y -> named_struct('start', y.x.start, 'end', y.x.end, 'kind', y.x.kind, 'p', {score.replace('f.', 'y.f.')}))"
    df = df.withColumn("more_", F.expr(f"array_sort(filter({scored}, x -> x.p >= case {limit} end))")).drop(*MORE)
    best = f"case when size(more_) < 2 then more_ else {let('cs', 'more_', BEST)} end"
    return df.select("row", "base", F.expr(f"array_sort(concat(base, transform({best}, x -> {shape})))").alias("spans"))


def _mask(at: str, i: str) -> tuple[str, str]:
    x = f"sp[{i}]"
    part = f"if({x}.end > {at}, array(substr(near, {at} - o.at + 1, greatest(0, {x}.start - {at})), repeat('{MASK}', {x}.end - greatest({at}, {x}.start))), cast(array() as array<string>))"
    return f"greatest({at}, {x}.end)", part


def _better(at: str, i: str) -> tuple[str, str]:
    x = f"cs[{i}]"
    apart = f"{x}.start >= {at}.end"
    return f"if({apart} or {x}.p > {at}.p, {x}, {at})", f"if({apart}, array({at}), cast(array() as array<{CANDIDATE}>))"


#: The part of the text ``raw`` that a chunk of the spans ``sp`` looks at: a long text is not walked from its start for each span.
GAPS = "substr(raw, o.at + 1, greatest(0, sp[last].start - o.at))"
#: The text ``raw`` with its spans ``sp`` overwritten.
MASKED = f"concat(array_join({fold('size(sp)', 'string', '0', _mask, near=GAPS)}, ''), substr(raw, array_max(transform(sp, x -> x.end)) + 1))"
#: Of candidates ``cs`` that overlap, from left to right, the one with the higher score.
BEST = fold("size(cs)", CANDIDATE, "cs[0]", _better, finish="concat(flatten(o.parts), array(o.at))")


def find(docs: DataFrame) -> DataFrame:
    """docs plus base and spans: arrays of (start, order, kind, end), by start and then kind; offsets in code points.

    A null text is empty and has no spans. Texts are searched whole, however long. Repeated rows and null ids
    stay; an empty table gives no rows. Added spans never overlap base ones, nor each other. Columns of the input named base or spans are replaced, others stay whatever their names.
    """
    found = _found(docs)
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("base", "spans")], "base", "spans")


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op7."""
    found = find(docs.select(F.col("doc_id").cast("long"), "text"))
    counts = [F.expr(f"size(filter(base, x -> x.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The same columns, whatever their names, with each selected span of ``text`` replaced by its kind in brackets; overlapping spans merge.

    A null text stays null; rows without spans stay as they are; an empty table gives no rows.
    """

    def step(at: str, i: str) -> tuple[str, str]:
        x = f"sp[{i}]"
        piece = f"if({x}.start >= {at}, array(substr(near, {at} - o.at + 1, {x}.start - {at}), concat('[', upper({x}.kind), ']')), cast(array() as array<string>))"
        return f"greatest({at}, {x}.end)", piece

    text = let("sp", "spans", let("raw", "cast(row.text as string)", f"concat(array_join({fold('size(sp)', 'string', '0', step, near=GAPS)}, ''), substr(raw, array_max(transform(sp, x -> x.end)) + 1))"))
    return unnested(_found(docs), docs.columns, text=F.expr(f"case when size(spans) > 0 then {text} else row.text end"))
