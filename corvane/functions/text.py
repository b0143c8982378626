"""Column functions on text: words, normal form, slugs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that the word tables leave out.
STOP_WORDS = """
the and with that for this from they their than rather through both across between one into about all are not
then which but what how them also each several more its only where these any being via would two three four
his her was were had has have been will can may could should did does within without before after over under very
when while here there thus such some most other same just like even well use used using you your our we
it at an or so do be by up out on in of to a i is as am get got let see now too yes no
ok yeah sure think know want need make made take takes give gives look looks come goes say says said tell told
ask asked try tried work works something anything everything nothing someone anyone everyone actually really quite already
always never often still might much many few lot bit way thing things time times
redacted claude message conversation chat response user assistant
""".split()
WORD = r"[a-z][a-z'\-]{2,}"


def words(text: Column, stop: list[str] | None = None) -> Column:
    """The words of three letters or more in lower case, repeats kept, stop words left out."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(STOP_WORDS if stop is None else stop))


def normalised(text: Column) -> Column:
    """White space runs as one space, ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))


def slug(title: Column, size: int = 100, default: str = "conversation") -> Column:
    """Lower case, other characters than a-z and 0-9 as one underscore, cut to ``size``; ``default`` if nothing is left."""
    bare = F.substring(F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, size)
    return F.coalesce(F.when(bare != "", bare), F.lit(default))


def letters(text: Column) -> Column:
    """The letters a-z and digits alone, in lower case."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def windows(text: Column, size: int = 60, reach: int = 300, least: int = 25) -> Column:
    """The letters of the first line, cut to ``size``, then consecutive windows of all letters up to ``reach``; those under ``least`` are left out."""
    whole = letters(text)
    upto = F.least(F.length(whole), F.lit(reach))
    rest = F.transform(F.sequence(F.lit(0), upto - 1, F.lit(size)), lambda i: F.substring(whole, i + 1, F.lit(size)))
    subject = F.array(F.substring(letters(F.substring_index(text, "\n", 1)), 1, size))
    return F.filter(F.when(upto > 0, F.concat(subject, rest)).otherwise(subject), lambda w: F.length(w) >= least)


def number_twin(word: Column) -> Column:
    """The word's plural or singular twin; null for names, short words and words on a double s."""
    n = F.length(word)
    one = lambda drop, add: F.concat(F.substring(word, F.lit(1), n - drop), F.lit(add))
    kept = (F.lower(F.substring(word, 1, 1)) != F.substring(word, 1, 1)) | word.endswith("ss") | (n < 4)
    return F.when(~kept, F.when(word.endswith("ies"), one(3, "y")).when(word.endswith("s"), one(1, "")).when(word.endswith("y"), one(1, "ies")).otherwise(one(0, "s")))


def reason(line: Column, width: int = 120) -> Column:
    """A fault's first line without its prefix and colon pairs, cut to ``width``."""
    prefix = "Validation error: "
    bare = F.replace(F.when(line.startswith(prefix), F.substring(line, F.lit(len(prefix) + 1), F.length(line))).otherwise(line), F.lit(": "), F.lit(" - "))
    return F.when(F.length(bare) <= width, bare).otherwise(F.concat(F.substring(bare, 1, width - 3), F.lit("...")))


def human_size(n: Column) -> Column:
    """Bytes as B, K, M or G without decimals, beyond that as T with one."""
    n = n.cast("double")
    said = F.lit(None).cast("string")
    for power, unit in reversed(list(enumerate("BKMG"))):
        said = F.when(n < 1024.0 ** (power + 1), F.format_string("%.0f" + unit, F.bround(n / 1024.0**power))).otherwise(said if unit != "G" else F.format_string("%.1fT", F.bround(n / 1024.0**4, 1)))
    return said


def signed_change(was: Column, now: Column) -> Column:
    """``now (+d)``."""
    return F.format_string("%d (%+d)", now.cast("long"), (now - was).cast("long"))


def uuid7_instant(anchor: Column) -> Column:
    """The instant in the first 48 bits of a version 7 UUID; null for anything else."""
    bits = F.conv(F.substring(F.replace(anchor, F.lit("-"), F.lit("")), 1, 12), 16, 10).cast("long")
    return F.when(anchor.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[0-9a-f]{4}-[0-9a-f]{12}$"), F.timestamp_millis(bits))


#: Container folders that are no part of a file's own path, in order of trial.
CONTAINERS = ["/home/claude/", "/mnt/user-data/outputs/", "/mnt/user-data/"]


def safe_path(raw: Column) -> Column:
    """The path below its container folder; null where it stays absolute or climbs with ``..``."""
    below = raw
    for prefix in reversed(CONTAINERS):
        below = F.when(raw.startswith(prefix), F.substring(raw, F.lit(len(prefix) + 1), F.length(raw))).otherwise(below)
    parts = F.filter(F.split(below, "/"), lambda x: ~x.isin("", "."))
    said = F.when(F.size(parts) == 0, F.lit(".")).otherwise(F.array_join(parts, "/"))
    return F.when(~below.startswith("/") & ~F.array_contains(parts, ".."), said)


def trimmed_instant(stamp: Column) -> Column:
    """An ISO stamp without its sub-seconds."""
    return F.regexp_replace(stamp, r"\.[0-9]+Z$", "Z")


def iso(at: Column) -> Column:
    """A timestamp as ``2024-01-31T12:00:00Z`` (session zone UTC)."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def export_instant(name: Column) -> Column:
    """The instant an export's folder name says: an explicit date and time before an epoch in seconds; null where it says none."""
    explicit = F.try_to_timestamp(F.nullif(F.regexp_extract(name, r"([0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]{2}-[0-9]{2}-[0-9]{2})", 1), F.lit("")), F.lit("yyyy-MM-dd-HH-mm-ss"))
    epoch = F.timestamp_seconds(F.nullif(F.regexp_extract(name, "(?:^|[^0-9])([0-9]{10})(?:[^0-9]|$)", 1), F.lit("")).cast("long"))
    return F.coalesce(explicit, epoch)


def fingerprint(text: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of a text."""
    return F.substring(F.sha2(text, 256), 1, 16)


def project_key(path: Column) -> Column:
    """A path with every character but letters and digits as a dash."""
    return F.regexp_replace(path, r"[^\p{L}\p{N}]", "-")


def version_number(version: Column) -> Column:
    """The first number in a version's name; -1 where it has none."""
    return F.coalesce(F.nullif(F.regexp_extract(version, "[0-9]+", 0), F.lit("")).cast("long"), F.lit(-1).cast("long"))


SIGNATURE = r"^Signature: ([A-Za-z0-9_-]+)(?:/([A-Za-z0-9_-]+)/([A-Za-z0-9_-]{1,8}))?\s*$"


def signature(line: Column) -> Column:
    """struct(machine, provider, session) of a signature line; null for any other line, parts it does not name null."""
    part = lambda i: F.nullif(F.regexp_extract(line, SIGNATURE, i), F.lit(""))
    return F.when(line.rlike(SIGNATURE), F.struct(part(1).alias("machine"), part(2).alias("provider"), part(3).alias("session")))


def was(now: Column, before: Column) -> Column:
    """``new (was old)``."""
    return F.concat(now.cast("string"), F.lit(" (was "), before.cast("string"), F.lit(")"))


def binary_mime(mime: Column) -> Column:
    """True for media types of documents and media; null is no type and false."""
    known = ["application/vnd.", "application/pdf", "application/msword", "image/", "audio/", "video/"]
    hit = F.lit(False)
    for prefix in known:
        hit = hit | mime.startswith(prefix)
    return F.coalesce(hit, F.lit(False))


def block_text(content: Column) -> Column:
    """The text of blocks array<struct<type, text>>: text blocks trimmed, blank ones left out, parted by blank lines."""
    said = F.transform(F.filter(content, lambda b: b["type"] == "text"), lambda b: F.trim(b["text"]))
    return F.array_join(F.filter(said, lambda s: s != ""), "\n\n")


def user_request(content: Column) -> Column:
    """What stands inside <USER_REQUEST>, else the whole, trimmed."""
    inner = r"(?s)<USER_REQUEST>\s*(.*?)\s*</USER_REQUEST>"
    return F.trim(F.when(content.rlike(inner), F.regexp_extract(content, inner, 1)).otherwise(content))


def without_frontmatter(md: Column) -> Column:
    """The markdown without a leading block between ``---`` lines and the blank lines after it."""
    return F.regexp_replace(md, r"(?s)\A---\n.*?\n---\n\n*", "")


def frontmatter(md: Column) -> Column:
    """The items of the leading block as map<string, string>; empty where there is none. Of a repeated key the last counts."""
    block = F.regexp_extract(md, r"(?s)\A---\n(.*?)\n---\n", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: F.contains(x, F.lit(": ")))
    pairs = F.transform(lines, lambda x: F.struct(F.substring_index(x, ": ", 1).alias("key"), F.substring(x, F.instr(x, ": ") + 2, F.length(x)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def conversation_id(md: Column) -> Column:
    """The uuid item near the start, else the last part of the first link's path; null where there is neither."""
    own = F.nullif(F.regexp_extract(F.substring(md, 1, 500), r"(?m)^uuid: ([0-9a-f-]{36})$", 1), F.lit(""))
    url = F.nullif(F.regexp_extract(md, r"<(https?://[^>]+)>", 1), F.lit(""))
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", "")
    return F.coalesce(own, F.substring_index(path, "/", -1))


HEREDOC = r"(?s)cat\s*>\s*(\S+)\s*<<\s*'(\w+)'\n(.*?)\n\2"


def heredocs(command: Column) -> Column:
    """array<struct<path, content>> of the quoted here-documents that a command writes with ``cat >``."""
    paths, contents = (F.regexp_extract_all(command, F.lit(HEREDOC), F.lit(i)) for i in (1, 3))
    return F.zip_with(paths, contents, lambda p, c: F.struct(p.alias("path"), c.alias("content")))


def folds(word: Column) -> Column:
    """The word and, where it has one, its twin in the other number."""
    twin = number_twin(word)
    return F.when(twin.isNull(), F.array(word)).otherwise(F.array(word, twin))


#: Words that never anchor a concept.
ANCHOR_STOPS = ["a", "an", "and", "as", "at", "by", "for", "in", "of", "on", "or", "the", "to", "vs", "with"]


def runs(concept: Column) -> Column:
    """The concept, every run of two or more of its content words, longest first, then its hyphenated words; repeats by case left out."""
    found = F.filter(F.regexp_extract_all(concept, F.lit("[A-Za-z][A-Za-z'’-]*"), F.lit(0)), lambda w: ~F.lower(w).isin(ANCHOR_STOPS))
    n = F.size(found)
    sizes = F.when(n > 1, F.reverse(F.sequence(F.lit(2), n))).otherwise(F.array().cast("array<int>"))
    spans = F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice(found, i, k), " ")))
    return _first_by_case(F.concat(F.array(concept), F.flatten(spans), F.filter(found, lambda w: F.contains(w, F.lit("-")))))


def phrasings(concept: Column) -> Column:
    """Each run with each of its words in either number, in the order of the runs; repeats by case left out."""

    def variants(run: Column) -> Column:
        start = F.array(F.array().cast("array<string>"))
        grown = lambda vs, w: F.flatten(F.transform(vs, lambda v: F.transform(folds(w), lambda f: F.concat(v, F.array(f)))))
        return F.transform(F.aggregate(F.split(run, " "), start, grown), lambda v: F.array_join(v, " "))

    return _first_by_case(F.flatten(F.transform(runs(concept), variants)))


def _first_by_case(items: Column) -> Column:
    """The items without later ones that differ in case only."""
    low = F.transform(items, F.lower)
    return F.filter(items, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def pointer_step(step: Column) -> Column:
    """A key as one step of a JSON pointer."""
    return F.replace(F.replace(step, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def divergence(a: Column, b: Column) -> Column:
    """The first place (from 0) where two arrays differ; the shorter size where one begins the other, null where they are equal."""
    differs = F.filter(F.sequence(F.lit(0), F.least(F.size(a), F.size(b))), lambda i: (i < F.least(F.size(a), F.size(b))) & ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return F.when(F.size(differs) > 0, F.get(differs, F.lit(0))).when(F.size(a) != F.size(b), F.least(F.size(a), F.size(b)))
