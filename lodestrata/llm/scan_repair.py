"""Repair of text taken from scanned or printed pages.

Pages of a document are read in order. Page furniture is found at their edges:
page numbers, lines that come back at the same edge within ``NEAR`` pages (compared
with digits masked, tolerating noise), top lines set apart in two parts, and specks anywhere. A line's last word
is broken if it ends in a hyphen and the next line of text, on the next page if
need be, goes on with a small letter and no conjunction.

Misread characters: texts that weren't scanned give the vocabulary, with
counts. A word of a page that isn't in it is looked up in tries of the
vocabulary by a Levenshtein automaton of two errors (one for words of two
letters), which retrieves every candidate that differs in one place of at most
two characters. Vocabulary and words are sharded by half of what such a place
leaves, at the word's beginning or at its end. How often one string of characters
was put for another over all unambiguous look-ups gives the confusions; those that
are frequent, or put a sign or digit inside letters, explain a misreading.
Candidates are ranked by the confusion's weight, the candidate's count, and
whether it stands after the same word elsewhere in the vocabulary's texts.

Null texts give nothing; duplicate rows count once.
"""

from __future__ import annotations

import difflib
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

#: Words of the vocabulary known to every task, the most frequent ones; a bound of about one MB.
KNOWN = 50_000
#: Vocabulary words need so many occurrences, and candidates so many per occurrence of the odd word.
LEAST_COUNT, RATIO = 1, 1
#: Least number and share of the confusions that count; so there are at most 250.
LEAST_CONFUSED, LEAST_SHARE = 3, 0.004
#: Pages within which a line comes back at the same edge if it is furniture.
NEAR = 4
#: Vocabulary words of one shard bucket, about.
SHARD_WORDS = 5_000

HYPHENS = "-­‐‑¬"
_CONJUNCTIONS = {"und", "oder", "bzw", "sowie", "bis", "and", "or", "to", "als"}
_ROMAN = r"[IVXLC]{1,7}"
_PAGE = re.compile(rf"(?:(?:seite|page|blatt|s\.|p\.)\s*)?[-–—\[\(|·.\s]*(?:\d{{1,4}}|{_ROMAN})(?:\s*(?:von|of|/)\s*\d{{1,4}})?[-–—\]\)|·.\s]*", re.IGNORECASE)
_APART = re.compile(r"\S {3,}\S")
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")
_INNER = re.compile(r"[^\W\d_]")


def tokens(line: str) -> list[str]:
    """Words of a line without the marks at their ends."""
    return [t for t in (_EDGE.sub("", x) for x in line.split()) if t]


# --- the pages of one document


def _norm(line: str) -> str:
    return re.sub(r"\s+", " ", re.sub(r"\d+", "#", line.lower())).strip(" #·|-–")


def _alike(a: str, b: str) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > 0.2 * max(len(a), len(b)) or min(len(a), len(b)) < 8:
        return False
    m = difflib.SequenceMatcher(None, a, b, autojunk=False)
    return m.quick_ratio() >= 0.85 and m.ratio() >= 0.85


def furniture(pages: list[list[str]]) -> list[set[int]]:
    """Numbers of the furniture lines of each page of a document."""
    out = [{i for i, x in enumerate(lines) if x.strip() and not any(c.isalnum() for c in x)} for lines in pages]
    edges: list[tuple[int, int, str, bool]] = []
    for p, lines in enumerate(pages):
        solid = [i for i, x in enumerate(lines) if x.strip() and i not in out[p]]
        for at_top, order in ((True, solid[:2]), (False, solid[::-1][:2])):
            for i in order:
                if _PAGE.fullmatch(lines[i].strip()):
                    out[p].add(i)
                    continue
                edges.append((p, i, _norm(lines[i]), at_top))
                break
    last: dict[tuple[str, bool], int] = {}
    near: set[tuple[str, bool]] = set()
    for p, _, x, top in edges:
        if p - last.get((x, top), -NEAR - 1) <= NEAR:
            near.add((x, top))
        last[x, top] = p
    by_length: dict[tuple[int, bool], list[str]] = {}
    for x, top in near:
        if len(x) >= 4:
            by_length.setdefault((len(x), top), []).append(x)
    alike: dict[tuple[str, bool], bool] = {}
    for p, i, x, top in edges:
        if (x, top) not in alike:
            lengths = range(int(len(x) * 0.8), int(len(x) * 1.25) + 2) if len(x) >= 8 else ()
            alike[x, top] = len(x) >= 4 and (x, top) in near or any(_alike(x, y) for n in lengths for y in by_length.get((n, top), ()))
        # a top line set apart in two parts is a running head even on a single page
        if alike[x, top] or (top and _APART.search(pages[p][i].strip())):
            out[p].add(i)
    for p, lines in enumerate(pages):  # numbers that stood behind a header or footer
        solid = [i for i, x in enumerate(lines) if x.strip() and i not in out[p]]
        for i in {*solid[:1], *solid[-1:]}:
            if _PAGE.fullmatch(lines[i].strip()) and (len(lines) == 1 or i in (0, len(lines) - 1) or i - 1 in out[p] or i + 1 in out[p]):
                out[p].add(i)
    return out


def broken(line: str, following: str) -> bool:
    """Whether the last word of a line goes on in the following one."""
    a, b = line.rstrip(), following.lstrip()
    if len(a) < 2 or a[-1] not in HYPHENS or not a[-2].isalpha() or not b[:1].islower():
        return False
    word = tokens(b.split(None, 1)[0])
    return not (word and word[0] in _CONJUNCTIONS)


def read_document(pages: list[list[str]]):
    """Yields (page, line, kind, token, page and line of a broken word's rest, its first part's length, word before)."""
    frame = furniture(pages)
    for p, lines in enumerate(frame):
        for i in sorted(lines):
            yield p, i, "furniture", None, None, None, None, None
    flow = [(p, i, x) for p, lines in enumerate(pages) for i, x in enumerate(lines) if x.strip() and i not in frame[p]]
    rest = None
    before = ""
    for k, (p, i, x) in enumerate(flow):
        words = x.split()
        start = 0
        if rest is not None:  # the first word was taken with the line before
            start, rest = 1, None
        goes_on = k + 1 < len(flow) and broken(x, flow[k + 1][2])
        for w in words[start : len(words) - goes_on]:
            t = _EDGE.sub("", w)
            if t:
                yield p, i, "token", t, None, None, None, before
                before = t
        if goes_on:
            q, j, y = flow[k + 1]
            yield p, i, "hyphen", None, None, None, None, None
            if start and len(words) == 1:  # a word over three lines
                rest = True
                continue
            head = words[-1].rstrip(HYPHENS)
            head = re.sub(r"^[^\w]+", "", head)
            tail = re.sub(r"[^\w]+$", "", y.split(None, 1)[0])
            if head and tail:
                yield p, i, "token", head + tail, q, j, len(head), before
                before = head + tail
            rest = True


PAGE_ROWS = "doc string, item string, line_no int, kind string, token string, item2 string, line2 int, head int, before string"


def read_pages(df: DataFrame, known: set[str]) -> DataFrame:
    """``PAGE_ROWS`` of (item, doc, ord, text): furniture, broken words, and the words not in ``known``."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_pages = df.select(F.col("doc").cast("string").alias("doc"), "ord", "item", "text").repartition(partitions, "doc").sortWithinPartitions("doc", "ord", "item")

    def emit(doc, items, texts, into):
        for p, i, kind, token, q, j, head, before in read_document([t.split("\n") for t in texts]):
            if kind != "token" or token not in known:
                for c, v in zip(into, (doc, items[p], i, kind, token, None if q is None else items[q], j, head, before)):
                    c.append(v)

    def flush(into):
        kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(into, kinds)], names=[x.split()[0] for x in PAGE_ROWS.split(", ")])

    def run(batches):
        doc, items, texts, into = None, [], [], [[] for _ in range(9)]
        for batch in batches:
            for d, item, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if d != doc and items:
                    emit(doc, items, texts, into)
                    items, texts = [], []
                    if len(into[0]) > 50_000:
                        yield flush(into)
                        into = [[] for _ in range(9)]
                doc = d
                items.append(item)
                texts.append(text)
        if items:
            emit(doc, items, texts, into)
        yield flush(into)

    return sorted_pages.mapInArrow(run, PAGE_ROWS)


# --- the vocabulary


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts, words as ``tokens`` cuts them; counted in each task before the shuffle."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(t.split())
            if len(counts) > 400_000:
                yield from _counted(counts)
                counts = Counter()
        yield from _counted(counts)

    return df.filter(F.col(text).isNotNull()).select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter):
    words: Counter = Counter()
    for w, n in counts.items():
        t = _EDGE.sub("", w)
        if t and _INNER.search(t):
            words[t] += n
    yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])


def half(n: int) -> int:
    """Letters that a word of n has in common with any misreading of one place of two characters, at its beginning or at its end."""
    return max(1, (n - 1) // 2)


def asked_keys(word: str) -> list[str]:
    """Shards in which the word may be that a misread one stood for.

    One place of at most two characters is misread; so the rest of at least
    n - 2 letters is the word's beginning and end, and one of the two has half
    of it.
    """
    low, h = word.lower(), half(len(word))
    return ["p" + low[:h], "s" + low[-h:]]


def shard_keys(word: str) -> list[str]:
    """Shards of a vocabulary word: its beginnings and ends that misreadings of it, up to two letters shorter or longer, may ask for."""
    low = word.lower()
    halves = {half(n) for n in range(max(1, len(low) - 2), len(low) + 3)}
    return [k for h in sorted(halves) if h <= len(low) for k in ("p" + low[:h], "s" + low[-h:])]


class Trie:
    """Words by their letters; a Levenshtein automaton walks it and gives all words within ``errors``."""

    def __init__(self, words):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def within(self, query: str, errors: int) -> list[tuple[str, int]]:
        """All words at most ``errors`` insertions, deletions and substitutions away.

        The automaton's state after a prefix is the band of the edit matrix's row
        around its diagonal; a branch is left when the whole band is above ``errors``.
        """
        n, found = len(query), []
        stack = [(self.root, 0, list(range(min(errors, n) + 1)), 0)]
        while stack:
            node, depth, row, lo = stack.pop()
            for c, child in node.items():
                if c == "":
                    k = n - lo
                    if 0 <= k < len(row) and row[k] <= errors:
                        found.append((child, row[k]))
                    continue
                d = depth + 1
                a, b = max(0, d - errors), min(n, d + errors)
                new, least = [], errors + 1
                for j in range(a, b + 1):
                    if j == 0:
                        v = d
                    else:
                        i = j - 1 - lo
                        v = row[i] + (query[j - 1] != c) if 0 <= i < len(row) else errors + 1
                        if 0 <= i + 1 < len(row) and row[i + 1] + 1 < v:
                            v = row[i + 1] + 1
                        if new and new[-1] + 1 < v:
                            v = new[-1] + 1
                    new.append(v)
                    if v < least:
                        least = v
                if least <= errors:
                    stack.append((child, d, new, a))
        return found


def difference(odd: str, word: str) -> tuple[str, str]:
    """(what stands in ``odd``, what stood in ``word``) between their common beginning and end."""
    i = 0
    while i < min(len(odd), len(word)) and odd[i] == word[i]:
        i += 1
    j = 0
    while j < min(len(odd), len(word)) - i and odd[-1 - j] == word[-1 - j]:
        j += 1
    return odd[i : len(odd) - j], word[i : len(word) - j]


def candidates(odd: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(odd, odd_n, word, n, got, was): every vocabulary word within two errors of each odd word, in one place of at most two characters."""
    buckets = max(32, vocabulary.count() // SHARD_WORDS)

    def keyed(names, shards):
        def run(batches):
            for batch in batches:
                word, n = batch.column(0).to_pylist(), batch.column(1)
                keys = [shards(w) for w in word]
                of = pa.array([i for i, k in enumerate(keys) for _ in k], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([x for k in keys for x in k], pa.string()), batch.column(0).take(of), n.take(of)], names=["key", *names])

        return run

    v = vocabulary.select("word", "n").mapInArrow(keyed(["word", "n"], shard_keys), "key string, word string, n long").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    q = odd.select("odd", "odd_n").mapInArrow(keyed(["odd", "odd_n"], asked_keys), "key string, odd string, odd_n long").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        asked: dict[str, list] = {}
        for key, w, n in zip(*(left.column(c).to_pylist() for c in ("key", "odd", "odd_n"))):
            asked.setdefault(key, []).append((w, n))
        held: dict[str, dict[str, int]] = {}
        for key, w, n in zip(*(right.column(c).to_pylist() for c in ("key", "word", "n"))):
            if key in asked:
                held.setdefault(key, {})[w] = n
        out = [[] for _ in range(6)]
        for key, words in held.items():
            trie = Trie(words)
            for w, n in asked[key]:
                for found, _ in trie.within(w, min(2, len(w) - 1)):
                    if found == w:
                        continue
                    got, was = difference(w, found)
                    if len(got) <= 2 and len(was) <= 2 and not (got.lower() == was.lower()):
                        for c, x in zip(out, (w, n, found, words[found], got, was)):
                            c.append(x)
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(("odd", "odd_n", "word", "n", "got", "was"), out, kinds)})

    # the cost of a bucket is in its look-ups, so buckets aren't put together by their bytes
    q, v = q.repartition(buckets, "bucket"), v.repartition(buckets, "bucket")
    found = q.groupBy("bucket").cogroup(v.groupBy("bucket")).applyInArrow(look_up, "odd string, odd_n long, word string, n long, got string, was string")
    return found.distinct()


def confusions(found: DataFrame) -> dict[tuple[str, str], float]:
    """Weight of each (got, was) over the look-ups with a single candidate: its share, of the frequent ones alone.

    Only places inside words count, as endings differ by grammar, and only
    characters put for others, as misreading neither adds nor drops any.
    """
    inside = ~F.expr("endswith(odd, got)") & ~F.expr("startswith(odd, got)") & (F.col("got") != "") & (F.col("was") != "")
    single = found.groupBy("odd").agg(F.count("*").alias("k"), F.first("got").alias("got"), F.first("was").alias("was")).filter("k = 1").filter(inside)
    counted = single.groupBy("got", "was").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_CONFUSED)
    total = single.count() or 1
    rows = counted.filter(F.col("n") >= LEAST_SHARE * total).collect()
    return {(r.got, r.was): r.n / total for r in rows}


def _sign(got: str) -> bool:
    return any(not c.isalpha() for c in got)


def corrections(odd: DataFrame, vocabulary: DataFrame, rows: DataFrame, clean: DataFrame, text: str) -> DataFrame:
    """(odd, word): the best explanation of each odd word that is a misreading.

    ``rows`` has the words that odd words stand after, ``clean`` the texts in
    which candidates are looked for after the same words.
    """
    found = stage_table(candidates(odd, vocabulary), "candidates")
    weight = confusions(found)
    table = found.sparkSession.createDataFrame([(g, w, float(x)) for (g, w), x in weight.items()] or [("", "", 0.0)], "got string, was string, weight double")
    sign = F.col("got").rlike(r"[^\p{L}]") & F.col("was").rlike(r"^\p{L}")
    ranked = found.filter("got <> '' and was <> ''").join(F.broadcast(table), ["got", "was"], "left").withColumn("weight", F.coalesce("weight", F.when(sign, F.lit(0.002))))
    ranked = stage_table(ranked.filter("weight is not null and n >= %d * odd_n" % RATIO), "ranked")
    asked = ranked.groupBy("odd").agg(F.count("*").alias("k")).filter((F.col("k") > 1) | _like_a_code("odd")).select("odd")
    seen = after_same_word(rows, ranked.join(asked, "odd", "left_semi").select("odd", "word"), clean, text)
    score = F.log("weight") + F.log(F.col("n") + 1.0) + F.when(F.coalesce("seen", F.lit(0)) > 0, 2.0).otherwise(0.0)
    fitting = ranked.join(seen, ["odd", "word"], "left").filter(~_like_a_code("odd") | (F.col("seen") > 0))
    best = fitting.groupBy("odd").agg(F.max_by("word", F.struct(score, "word")).alias("word"))
    return best.unionByName(_inside_letters(odd.join(best.select("odd"), "odd", "left_anti").filter(~_like_a_code("odd")), weight))


def _like_a_code(word: str):
    """Short words of letters with digits before or after them, as numbers of rooms and tables have; as misreadings they need a context."""
    return (F.char_length(word) < 4) & F.col(word).rlike(r"^(?:\p{L}+\d+|\d+\p{L}+)$")


def _inside_letters(odd: DataFrame, weight: dict[tuple[str, str], float]) -> DataFrame:
    """(odd, word) of words without a candidate in which a sign stands for letters, by the confusions alone."""
    of = {}
    for (got, was), _ in sorted(weight.items(), key=lambda x: -x[1]):
        if len(got) == 1 and (not got.isalpha() or got.isupper()):
            of.setdefault(got, was)
    word = F.col("odd")
    for got, was in of.items():
        before = r"(?<=\p{Ll})" if got.isalpha() else r"(?<=\p{L})"
        word = F.regexp_replace(word, before + re.escape(got) + (r"(?=\p{Ll})" if got.isalpha() else r"(?=\p{L})"), was)
    return odd.select("odd", word.alias("word")).filter("word <> odd")


#: Slots of the filter that keeps other words from the context's shuffle, at most that many small numbers for each task.
SLOTS = 1 << 16


def _slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % SLOTS


def after_same_word(rows: DataFrame, found: DataFrame, clean: DataFrame, text: str) -> DataFrame:
    """(odd, word, seen): how often each candidate of ``found`` (odd, word) stands, in clean texts, after a word the odd one stood after."""

    def slots(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({_slot(w) for w in batch.column(0).to_pylist()}), pa.int32())], names=["slot"])

    open_slots = {r.slot for r in found.select("word").mapInArrow(slots, "slot int").distinct().collect()}

    def pairs(batches):
        wanted: dict[str, bool] = {}
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                words = tokens(t)
                for w in set(words).difference(wanted):
                    wanted[w] = _slot(w) in open_slots
                counts.update((a, b) for a, b in zip(words, words[1:]) if wanted[b])
            if len(counts) > 200_000:
                yield from _paired(counts)
                counts = Counter()
            if len(wanted) > 500_000:
                wanted = {}
        yield from _paired(counts)

    scan = clean.filter(F.col(text).isNotNull()).select(text)
    if not open_slots:
        scan = scan.limit(0)
    met = scan.mapInArrow(pairs, "before string, word string, n long")
    asked = rows.filter("kind = 'token' and before <> ''").select(F.col("token").alias("odd"), "before").distinct().join(found, "odd")
    return met.join(asked, ["before", "word"]).groupBy("odd", "word").agg(F.sum("n").alias("seen"))


def _paired(counts: Counter):
    yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in counts], pa.string()), pa.array([b for _, b in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["before", "word", "n"])


def repair(pages: DataFrame, clean: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, fixes): ``PAGE_ROWS`` of (item, doc, ord, text), and (odd, word) of the misread words.

    ``clean`` has texts that weren't scanned, for the vocabulary.
    """
    vocabulary = stage_table(word_counts(clean, text).filter(F.col("n") >= LEAST_COUNT), "vocabulary")
    known = {r.word for r in vocabulary.orderBy(F.desc("n"), "word").limit(KNOWN).select("word").collect()}
    rows = stage_table(read_pages(pages, known), "page_rows")
    rare = rows.filter("kind = 'token'").groupBy(F.col("token").alias("odd")).agg(F.count("*").alias("odd_n"))
    odd = rare.filter((F.char_length("odd") >= 2) & F.col("odd").rlike(r"\p{L}")).join(vocabulary.select(F.col("word").alias("odd")), "odd", "left_anti")
    return rows, stage_table(corrections(odd, vocabulary, rows, clean, text), "fixes")


def marked_lines(rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """(item, line_no, kind): furniture, hyphen and glyph lines."""
    plain = rows.filter("kind <> 'token'").select("item", "line_no", "kind")
    bad = rows.filter("kind = 'token'").join(fixes.withColumnRenamed("odd", "token"), "token")

    def place(batches):
        for batch in batches:
            token, item, line, item2, line2, head, word = (batch.column(i).to_pylist() for i in range(7))
            where = []
            for t, a, i, b, j, h, w in zip(token, item, line, item2, line2, head, word):
                same = next((k for k, (x, y) in enumerate(zip(t, w)) if x != y), min(len(t), len(w)))
                where.append((a, i) if h is None or same < h else (b, j))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in where], pa.string()), pa.array([i for _, i in where], pa.int32())], names=["item", "line_no"])

    glyph = bad.select("token", "item", "line_no", "item2", "line2", "head", "word").mapInArrow(place, "item string, line_no int").withColumn("kind", F.lit("glyph"))
    return plain.unionByName(glyph).distinct()


def paragraphs(pages: DataFrame, rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """(doc, text): each document's pages as continuous paragraphs, furniture gone, words whole and corrected."""
    doc_fixes = rows.filter("kind = 'token'").select("doc", F.col("token").alias("odd")).distinct().join(fixes, "odd").groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("odd", "word"))).alias("fixes"))
    whole = pages.select(F.col("doc").cast("string").alias("doc"), F.struct("ord", "item", "text").alias("p")).groupBy("doc").agg(F.sort_array(F.collect_list("p")).alias("p"))

    def run(batches):
        for batch in batches:
            docs, parts, fix = (batch.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.string()), pa.array([reflow([p["text"].split("\n") for p in ps], dict(f or [])) for ps, f in zip(parts, fix)], pa.string())], names=["doc", "text"])

    return whole.join(doc_fixes, "doc", "left").select("doc", "p", "fixes").mapInArrow(run, "doc string, text string")


def reflow(pages: list[list[str]], fixes: dict[str, str]) -> str:
    """Paragraphs of a document, one to a line."""
    frame = furniture(pages)
    out: list[str] = []
    for p, lines in enumerate(pages):
        fresh = bool(out) and p == 0
        for i, x in enumerate(lines):
            if i in frame[p]:
                continue
            x = x.strip()
            if not x:
                fresh = True
                continue
            # a new paragraph begins after an empty line, but not where a sentence goes on over a page
            if not out or (fresh and out[-1][-1:] in ".!?:;"):
                out.append(x)
            elif broken(out[-1], x):
                out[-1] = out[-1].rstrip(HYPHENS) + x
            else:
                out[-1] += " " + x
            fresh = False
    if fixes:
        out = [re.sub(r"\S+", lambda m: _fixed(m.group(), fixes), x) for x in out]
    return "\n".join(out)


def _fixed(word: str, fixes: dict[str, str]) -> str:
    t = _EDGE.sub("", word)
    return word.replace(t, fixes[t], 1) if t in fixes else word
