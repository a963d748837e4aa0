import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import name_variants as nv
from lodestrata.llm.scan_repair import Trie

SCHEMA = "entity_id long, original_name string, entity_type string, canonical_name string, id string"

GROUPS = [
    ["Brigitte Kerufuwobach", "Kerufuwobach, Gitti (Stadträtin)", "Dr. Brigitte Kerufuwobach", "Brigite Kerufuwobach", "B. Kerufuwobach", "KERUFUWOBACH BRIGITTE"],
    ["Dietmar Mekebahumann", "Dr. Dietmar B. Mekebahumann", "Diet. Mekebahumann", "Didi Mekebahumann"],
    ["Gertrud Mekebahumann", "Mekebahumann, Gertrud"],
    ["Stadtwerke Kaltambarstedt GmbH", "Kaltambarstedter Stadtwerke", "SW Kaltambarstedt", "Stadtwerke der Gemeinde Kaltambarstedt", "Stadtwerke Kaltambarstdet"],
    ["Stadtwerke Holholholbrück GmbH", "Holholholbrueck, Stadtwerke"],
    ["Tourismusverband Kaltambarstedt e.V.", "TV Kaltambarstedt"],
]


def test_variants_are_linked(spark):
    rows = [(100 * g + i, n, "Akteur", None, None) for g, names in enumerate(GROUPS) for i, n in enumerate(names)]
    rows += [(900, None, "Akteur", None, None), (901, "", "Akteur", None, None), (902, " – ", None, None, None), (903, "x" * 100_000, None, None, None), (904, "Stadtwerke Kaltambarstedt GmbH", "Infrastruktur", None, None)]
    rows += rows[:3]
    out = nv.resolve(spark.createDataFrame(rows, SCHEMA), "entity_id", "original_name", "entity_type").collect()
    got = {}
    for r in out:
        got.setdefault(r.group, set()).add(r.entity_id)
    pairs = {p for ids in got.values() for p in itertools.combinations(sorted(ids), 2)}
    true = {(100 * g + i, 100 * g + j) for g, names in enumerate(GROUPS) for i, j in itertools.combinations(range(len(names)), 2)}
    assert pairs == true
    names = {r.entity_id: r.canonical_name for r in out}
    assert names[2] == names[0] and "Kerufuwobach" in names[0] and 900 not in names and 901 not in names
    assert nv.resolve(spark.createDataFrame([], SCHEMA), "entity_id", "original_name", "entity_type").count() == 0


def test_swap_is_one_edit():
    assert nv.osa("angelika", "angleika") == 1 and nv.osa("abc", "cab") == 2 and nv.osa("", "ab") == 2


@settings(max_examples=400, deadline=None)
@given(st.text("abcd", min_size=5, max_size=13), st.lists(st.tuples(st.integers(0, 12), st.sampled_from(["put", "insert", "delete", "swap"]), st.sampled_from("abcdx")), min_size=1, max_size=2))
def test_words_within_the_bound_share_a_shard(word, edits):
    other = word
    for at, kind, c in edits:
        at = min(at, len(other) - 1)
        other = {"put": other[:at] + c + other[at + 1 :], "insert": other[:at] + c + other[at:], "delete": other[:at] + other[at + 1 :], "swap": other[:at] + other[at : at + 2][::-1] + other[at + 2 :]}[kind]
    if other != word and len(other) >= 5 and nv.osa(word, other) <= min(nv.allowed(word), nv.allowed(other)) and (dict(Trie([word]).within(other, 2))):
        assert set(nv.asked_keys(other)) & set(nv.shard_keys(word))
        assert set(nv.asked_keys(word)) & set(nv.shard_keys(other))


def test_planted_variants(spark):
    """Typos, swapped parts and initials of invented names: at least 0.9 of the pairs, none between names."""
    r = random.Random(6)
    syllables = ["ka", "lo", "mer", "tin", "bu", "ras", "vel", "dom", "hin", "gor", "pau", "stel", "wim", "zan", "fro"]
    word = lambda k: "".join(r.choice(syllables) for _ in range(k)).title()
    rows, group = [], {}
    for g in range(60):
        first, last = word(3), word(4)
        at = r.randrange(1, len(last) - 1)
        typo = last[:at] + r.choice("xyq") + last[at + 1 :]
        swapped = last[:at] + last[at : at + 2][::-1] + last[at + 2 :]
        for i, n in enumerate([f"{first} {last}", f"{last}, {first}", f"{first} {typo}", f"{first[0]}. {last}", f"{first} {swapped}", f"{first} {last}"]):
            group[10 * g + i] = g
            rows.append((10 * g + i, n, "Akteur", None, None))
    out = nv.resolve(spark.createDataFrame(rows, SCHEMA), "entity_id", "original_name", "entity_type").collect()
    found = {}
    for x in out:
        found.setdefault(x.group, []).append(x.entity_id)
    pairs = {p for ids in found.values() for p in itertools.combinations(sorted(ids), 2)}
    right = [p for p in pairs if group[p[0]] == group[p[1]]]
    assert len(right) >= 0.9 * 60 * 15 and len(right) >= 0.99 * len(pairs)
