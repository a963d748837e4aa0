"""Variant spellings of names, linked by trie joins over their words.

A name is lower-cased, umlauts are written out, and titles, legal forms, remarks
in brackets and filler words are left out. Then

1. words are corrected: rare words are looked up in tries of all words by a
   Levenshtein automaton (``scan_repair.Trie``), within one error for words of
   five letters and two from eight on (a swap of neighbours counts as one). The
   tries are sharded by the words' lengths and parts, one part more than errors,
   of which one is always whole; so every word within the bound is met. Each
   goes to its most frequent neighbour, and so do words with an ending of up to
   two letters; words that names are written with and without are left out;
2. names whose corrected words are a permutation of each other share a key;
3. abbreviated names (initials, cut words, acronyms, nicknames of several names,
   or the family name alone) join the full names of their type that hold their longest word,
   and are attached where the rest fits exactly one of them, or one at least
   twice as frequent as any other.

Names of different types are never linked. Words are corrected in one step and
keys attached once, so groups can't grow by chains. Null and wordless names give
no rows; duplicate rows count once.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table
from .scan_repair import Trie

# Words that name no one.
TITLES = {"hr", "fr", "dr", "prof", "dipl", "ing", "bgm", "bgmin", "obm", "herr", "frau", "mag", "med", "phil", "jur", "rer", "nat", "mdl", "mdb", "stadtrat", "stadtraetin", "buergermeister", "buergermeisterin"}
LEGAL = {"gmbh", "ggmbh", "mbh", "ag", "kg", "co", "ohg", "gbr", "eg", "ev", "se", "kgaa", "gr", "ug", "aoer", "koer"}
FILLERS = {"der", "die", "das", "des", "dem", "den", "gemeinde", "in", "im", "von", "vom", "zu", "zur", "und", "fuer", "am", "an", "bei"}
# Familiar forms of given names.
NICKNAMES = {
    "gitti": "brigitte birgit", "uli": "ulrich ulrike", "ulli": "ulrich ulrike", "kathi": "katharina", "kati": "katharina", "steffi": "stefanie", "susi": "susanne", "hias": "matthias", "matze": "matthias",
    "didi": "dietmar dieter", "max": "maximilian", "maxi": "maximilian", "andi": "andreas", "sepp": "josef", "beppo": "josef", "jupp": "josef", "alex": "alexander alexandra", "fritz": "friedrich", "hans": "johannes johann",
    "hannes": "johannes", "willi": "wilhelm", "willy": "wilhelm", "heiner": "heinrich", "heinz": "heinrich", "chris": "christian christine christoph", "michi": "michael michaela", "michl": "michael", "toni": "anton antonia",
    "resi": "theresa theresia", "rosi": "rosemarie rosa", "lisa": "elisabeth", "sissi": "elisabeth", "elli": "elisabeth", "liesl": "elisabeth", "babsi": "barbara", "gretl": "margarete", "gretel": "margarete", "grete": "margarete", "gerti": "gertrud",
    "traudl": "gertrud", "angie": "angelika", "geli": "angelika", "leni": "helene magdalena", "lena": "helene magdalena", "moni": "monika", "schorsch": "georg", "wolfi": "wolfgang", "flo": "florian", "basti": "sebastian",
    "tom": "thomas", "tommy": "thomas", "jo": "johannes joachim", "jojo": "johannes joachim", "jockel": "jakob", "jackl": "jakob", "baerbel": "barbara", "gabi": "gabriele", "conny": "cornelia", "petra": "petra", "rudi": "rudolf", "klausi": "klaus",
}

_FOLD = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "é": "e", "è": "e", "á": "a", "à": "a", "ó": "o", "í": "i", "ú": "u", "ç": "c", "ñ": "n"})
_BRACKETS = re.compile(r"\([^)]*\)|\[[^\]]*\]")
_TOKEN = re.compile(r"[^\W_]+\.?")


def parts(name: str) -> tuple[list[str], bool]:
    """(words of a name in order, whether any is abbreviated)."""
    name = _BRACKETS.sub(" ", name)
    name = re.sub(r"\b([eE])\.\s*([vV])\.?", "ev", name)
    name = re.sub(r"\bi\.\s*gr\.?", " ", name, flags=re.IGNORECASE)
    name = re.sub(r"\b(bgm|obm)\.in\b", r"\1in", name, flags=re.IGNORECASE)
    # a single letter before a hyphen abbreviates the first part of its word
    name, joined = re.subn(r"\b([^\W\d_])-(?=[^\W\d_]{3})", r"\1", name)
    out, short = [], False
    found = _TOKEN.findall(name)
    for raw in found:
        plain = raw.rstrip(".")
        low = plain.lower().translate(_FOLD)
        if low in TITLES or low in LEGAL or (low in FILLERS and not raw.endswith(".")):
            continue
        if not any(c.isalpha() for c in low):
            continue
        if " " not in NICKNAMES.get(low, " "):  # the familiar form of one name only
            out.append(NICKNAMES[low])
            continue
        camel = any(a.islower() and b.isupper() for a, b in zip(plain, plain[1:])) and plain != "AG"
        dotted = raw.endswith(".") and len(low) < 14
        if dotted or len(low) < 4 or (camel and len(low) < 10) or low in NICKNAMES:
            short = True
        out.append(low)
    full = [w for w in out if len(w) > 1]
    if len(full) >= 2:  # a middle initial beside two words
        short = short and any(len(w) < 4 or w in NICKNAMES for w in full) or _dotted(found, full) or _camel(found, full)
        out = full
    return out, short or joined > 0 or len(out) < 2


def _dotted(found: list[str], full: list[str]) -> bool:
    return any(r.endswith(".") and r.rstrip(".").lower().translate(_FOLD) in full for r in found[:-1] + [x for x in found[-1:] if len(x) < 8])


def _camel(found: list[str], full: list[str]) -> bool:
    return any(len(r) < 10 and any(a.islower() and b.isupper() for a, b in zip(r, r[1:])) and r.rstrip(".").lower().translate(_FOLD) in full for r in found)


def osa(a: str, b: str) -> int:
    """Edit distance in which a swap of neighbours is one edit."""
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old2, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            v = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, old2[j - 2] + 1)
            row.append(v)
    return row[-1]


def allowed(word: str) -> int:
    return 0 if len(word) < 5 else 1 if len(word) < 8 else 2


def fits(rest: list[str], full: list[str]) -> bool:
    """Whether the words left of an abbreviated name can stand for those left of a full one."""
    if not rest:
        return True
    if not full:
        return False
    if len(rest) == 1 and rest[0] in NICKNAMES:
        names = NICKNAMES[rest[0]].split()
        return any(w in names for w in full) or any(w.startswith(rest[0]) for w in full)
    a, b = "".join(rest), "".join(full)
    if a[0] != b[0] or len(a) > len(b):
        return False
    it = iter(b)
    return all(c in it for c in a)


def _letters(batches):
    """A row for each letter that the rest of an abbreviated name may begin with in the full one."""
    for batch in batches:
        of, letters = [], []
        for i, (words, word) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            rest = [w for w in words if w != word]
            own = {rest[0][0]}
            if len(rest) == 1 and rest[0] in NICKNAMES:
                own |= {n[0] for n in NICKNAMES[rest[0]].split()}
            of += [i] * len(own)
            letters += sorted(own)
        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(of, pa.int64())) for c in batch.columns), pa.array(letters, pa.string())], names=[*batch.schema.names, "letter"])


def _parsed(df: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            words, short = zip(*(parts(x) for x in batch.column(2).to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(words), pa.list_(pa.string())), pa.array(list(short), pa.bool_())], names=["id", "kind", "words", "short"])

    return df.select("id", "kind", "name").mapInArrow(run, "id long, kind string, words array<string>, short boolean").filter(F.size("words") > 0)


#: Words of one bucket of shards, about.
BUCKET_WORDS = 500


def inflected(word: str, stem: str) -> bool:
    """Whether a long word is another with an ending of up to two letters."""
    return len(stem) >= 8 and word.startswith(stem) and len(word) - len(stem) <= 2


def optional_words(keyed: DataFrame) -> DataFrame:
    """(word,): words that names are written with and without: so are at least three names of two or more other words, and half of those that have it."""
    keys = keyed.select("kind", "key", "words").dropDuplicates(["kind", "key"])
    rest = F.concat_ws(" ", F.array_sort(F.array_except("words", F.array("word"))))
    having = keys.filter(F.size("words") >= 3).select("kind", "words", F.explode(F.array_distinct("words")).alias("word")).select("kind", "word", rest.alias("key"))
    without = having.join(keys.select("kind", "key", F.lit(1).alias("known")), ["kind", "key"], "left")
    return without.groupBy("word").agg(F.count("*").alias("n"), F.count("known").alias("m")).filter("m >= 3 and 2 * m >= n").select("word")


def segments_of(word: str) -> list[tuple[int, int]]:
    """(start, end) of the parts of a word of which any other within ``allowed`` edits leaves one whole: one part more than edits."""
    n, k = len(word), allowed(word) + 1
    return [(n * i // k, n * (i + 1) // k) for i in range(k)]


def shard_keys(word: str) -> list[str]:
    """Shards in which a word stands: its length, and each of its parts."""
    return [f"{len(word)}:{i}:{word[a:b]}" for i, (a, b) in enumerate(segments_of(word))]


def asked_keys(word: str) -> list[str]:
    """Shards that hold every word within the edits that both allow.

    A part that the edits spare stands in the word at its place or, after
    insertions and deletions, as many places beside it. Where one edit is
    allowed, a swap of neighbours may touch two parts; the word is then asked
    for with that swap undone.
    """
    out = set()
    for n in range(len(word) - allowed(word), len(word) + allowed(word) + 1):
        k = min(allowed(word), allowed("x" * n))
        if not k:
            continue
        parts = segments_of("x" * n)
        for i, (a, b) in enumerate(parts):
            for start in range(max(0, a - k), min(len(word) - (b - a), a + k) + 1):
                out.add(f"{n}:{i}:{word[start : start + b - a]}")
        if len(parts) == 2 and n == len(word):
            at = parts[1][0]
            whole = word[: at - 1] + word[at] + word[at - 1] + word[at + 1 :]
            out.add(f"{n}:0:{whole[:at]}")
    return sorted(out)


def corrected(counts: DataFrame) -> DataFrame:
    """(word, better): each rare word's most frequent neighbour, of (word, n)."""
    buckets = max(64, counts.count() // BUCKET_WORDS)

    def keyed(keys_of, names):
        def run(batches):
            for batch in batches:
                word, n = batch.column(0).to_pylist(), batch.column(1)
                keys = [keys_of(w) for w in word]
                of = pa.array([i for i, k in enumerate(keys) for _ in k], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([x for k in keys for x in k], pa.string()), batch.column(0).take(of), n.take(of)], names=["key", *names])

        return run

    def sharded(keys_of, words):
        rows = words.mapInArrow(keyed(keys_of, ["word", "n"]), "key string, word string, n long")
        # one task for each few shards: their cost is in the walks, not in their bytes
        return rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).repartition(buckets, "bucket")

    long_words = counts.filter(F.char_length("word") >= 5).select("word", "n")

    def look_up(asking: pa.Table, there: pa.Table) -> pa.Table:
        held: dict[str, dict[str, int]] = {}
        for key, w, n in zip(*(there.column(c).to_pylist() for c in ("key", "word", "n"))):
            held.setdefault(key, {})[w] = n
        tries = {}
        out = [[], [], []]
        for key, w, n in zip(*(asking.column(c).to_pylist() for c in ("key", "word", "n"))):
            words = held.get(key)
            if not words:
                continue
            if key not in tries:
                tries[key] = Trie(words)
            for other, _ in tries[key].within(w, 2):  # a swap is two plain edits
                m = words[other]
                if other == w or (m, other) < (n, w) or not (n <= max(2, m // 10) or inflected(w, other)):
                    continue
                d = osa(w, other)
                if d <= min(allowed(w), allowed(other)):
                    for c, x in zip(out, (w, other, 1000 * (3 - d) + min(m, 999))):
                        c.append(x)
        return pa.table({"word": pa.array(out[0], pa.string()), "better": pa.array(out[1], pa.string()), "score": pa.array(out[2], pa.int64())})

    near = sharded(asked_keys, long_words).groupBy("bucket").cogroup(sharded(shard_keys, long_words).groupBy("bucket")).applyInArrow(look_up, "word string, better string, score long")
    best = near.groupBy("word").agg(F.max_by("better", F.struct("score", "better")).alias("better"))
    once = stage_table(best, "word_map")
    then = once.select(F.col("word").alias("better"), F.col("better").alias("over"))
    return once.join(then, "better", "left").select("word", F.coalesce("over", "better").alias("better"))


def resolve(df: DataFrame, key: str, name: str, kind: str) -> DataFrame:
    """(key, canonical_name, group): the canonical name and the group of each row with a name."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(kind), F.lit("")).alias("kind"), F.col(name).alias("name")).filter("id is not null and name is not null").dropDuplicates(["id"])
    parsed = stage_table(_parsed(rows), "names")
    exploded = parsed.select("id", F.posexplode("words").alias("at", "word"))
    counts = exploded.groupBy("word").agg(F.count("*").alias("n"))
    better = corrected(counts)
    fixed = exploded.join(better, "word", "left").select("id", "at", F.coalesce("better", "word").alias("word"))
    words = fixed.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("words"))
    in_order = F.concat_ws(" ", F.array_sort("words"))
    full_words = stage_table(parsed.select("id", "kind", "short").join(words, "id").withColumn("key", in_order), "words")
    optional = optional_words(full_words).withColumn("optional", F.lit(True))
    needed = full_words.select("id", F.posexplode("words").alias("at", "word")).join(optional, "word", "left").filter("optional is null")
    needed = needed.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("needed"))
    kept = full_words.join(needed, "id", "left").withColumn("words", F.when(F.size("needed") >= 2, F.col("needed")).otherwise(F.col("words")))
    keyed = stage_table(kept.select("id", "kind", "short", "words").withColumn("key", in_order), "keys")
    keys = keyed.groupBy("kind", "key").agg(F.count("*").alias("n"), F.min_by("words", F.struct("short", "id")).alias("words"), F.min("short").alias("short"))
    keys = stage_table(keys, "name_keys")
    longest = F.array_max(F.transform("words", lambda w: F.struct(F.char_length(w).alias("l"), w.alias("w"))))["w"]
    short = keys.filter("short").select("kind", F.col("key").alias("short_key"), F.col("words").alias("short_words"), longest.alias("word")).filter(F.char_length("word") >= 5)
    full = keys.filter("not short").select("kind", "key", "words", "n", F.explode(F.array_distinct("words")).alias("word"))
    # what is left of an abbreviated name begins as one of the words left of the full one, so that names of a common word meet by that letter too
    left_of = lambda words: F.array_except(words, F.array("word"))
    bare, short = short.filter(F.size(left_of("short_words")) == 0), short.filter(F.size(left_of("short_words")) > 0)
    asks = short.mapInArrow(_letters, "kind string, short_key string, short_words array<string>, word string, letter string")
    letters = F.explode(F.array_distinct(F.transform(left_of("words"), lambda w: F.left(w, F.lit(1))))).alias("letter")
    offers = full.select("kind", "key", "words", "n", "word", letters)

    def check(batches):
        for batch in batches:
            a, b, w = (batch.column(i).to_pylist() for i in (2, 4, 6))
            ok = []
            for x, y, word in zip(a, b, w):
                rest, left = list(x), list(y)
                rest.remove(word)
                left.remove(word)
                for same in [t for t in rest if t in left]:
                    rest.remove(same)
                    left.remove(same)
                ok.append(bool(fits(rest, left)))
            yield batch.filter(pa.array(ok, pa.bool_()))

    pairs = asks.join(offers, ["kind", "word", "letter"]).select("kind", "short_key", "short_words", "key", "words", "n", "word")
    fits_ = pairs.mapInArrow(check, pairs.schema).select("kind", "short_key", "key", "n")
    # a word alone fits every name that holds it; the two most frequent of those decide
    two = full.groupBy("kind", "word").agg(F.max(F.struct("n", "key")).alias("first"))
    second = full.join(two, ["kind", "word"]).filter(F.col("key") != F.col("first.key")).groupBy("kind", "word").agg(F.max(F.struct("n", "key")).alias("second"))
    tops = two.join(second, ["kind", "word"], "left").select("kind", "word", F.explode(F.array_compact(F.array("first", "second"))).alias("top"))
    alone = bare.join(tops, ["kind", "word"]).select("kind", "short_key", F.col("top.key").alias("key"), F.col("top.n").alias("n"))
    ranked = fits_.unionByName(alone).distinct().withColumn("r", F.row_number().over(Window.partitionBy("kind", "short_key").orderBy(F.desc("n"), F.desc("key")))).filter("r <= 2")
    fitting = ranked.groupBy("kind", "short_key").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", F.struct("n", "key").alias("e")))), lambda x: x["e"]).alias("best"))
    attached = fitting.filter((F.size("best") == 1) | (F.col("best")[0]["n"] >= 2 * F.col("best")[1]["n"])).select("kind", F.col("short_key").alias("key"), F.col("best")[0]["key"].alias("to"))
    grouped = keyed.join(attached, ["kind", "key"], "left").select("id", "short", F.concat_ws("|", "kind", F.coalesce("to", "key")).alias("group")).join(rows.select("id", F.trim("name").alias("name")), "id")
    # the canonical name is the full spelling met most often, then the longest
    spelled = grouped.groupBy("group", "name").agg(F.count("*").alias("n"), F.min("short").alias("short"))
    canonical = spelled.groupBy("group").agg(F.max_by("name", F.struct((~F.col("short")).alias("f"), "n", F.char_length("name"), "name")).alias("canonical_name"))
    return grouped.join(canonical, "group").select(F.col("id").alias(key), "canonical_name", "group")
