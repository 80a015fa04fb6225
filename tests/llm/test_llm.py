"""The text operators on small tables: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from placeweave.llm import (
    components, encoding, exact_dedup, license_scan, ngram_join, packing, preferences, quality_rules, sentencepiece_bridge, sstable, toxicity, url_rules,
)
from placeweave.llm.shared import shared_dir

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, schema=DOC):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, "word " * 30000), (5, "a b"), (5, "a b"), (6, "a b"), (None, "lost one"), (7, "ünï ÇØDÉ 漢字 🙂")]


# -- encoding

def plainly(name, texts):
    """Ids of each text from a plain call of the library."""
    t = Tokenizer.from_file(P.path(name))
    return [np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


@pytest.mark.parametrize(("name", "keeps"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_encode_like_whole_texts(name, keeps):
    e = encoding.PieceEncoder(P.path(name), keeps, cache_bytes=2000)
    rng = random.Random(5)
    texts = []
    for alphabet in ("abcXYZéßØ .,!?'s#\n\t  3½中áΣς<|>\u0301", "abXé '\n 3.", "aB're l'd\r\n\t\x0b  9,;", "ab \u00a0\u2003\x1c\x85µª×÷ſKİı"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    texts += ["don't it's 3.5 foo.\nBar <|endoftext|> x", "plain <|endoftext|> text", "<|ENDOFTEXT|>", "<|startoftext|>a", "İs ÀÉ ss", "", " ", "a  b", "a \n b", "\n\n\na\n\nb\n", "x" * 5000]
    assert e.direct
    assert list(e.encode(texts)) == plainly(name, texts)


#: Neighbouring identifiers that no float tells apart, beside a null one.
BIG = [(2**60 + 1, "first big one of them"), (2**60 + 3, "other big one <|endoftext|> end"), (None, "nobody"), (-2**63, ""), (2**63 - 1, None)]


def test_identifiers_stay_whole_beside_nulls(spark):
    docs = docs_of(spark, BIG).coalesce(1)
    want = sorted((str(i), len(x) // 4 + 1, zlib.crc32(x + b"\x02\0\0\0")) for (i, t), x in zip(BIG, plainly("byte_bpe_50k.json", [t for _, t in BIG])))
    path = shared_dir(spark, "test")
    sstable.write(docs, path, P.path("byte_bpe_50k.json"), end_id=2, shards=1)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in sstable.summary(spark, path).collect()) == want
    packed = packing.pack(docs, P.path("word_bpe_49k.json"), end_id=1).collect()
    assert sorted(str(r["doc_id"]) for r in packed) == sorted(str(i) for i, _ in BIG)
    pieces = sentencepiece_bridge.encode(docs, P.path("piece_bpe_32k.model")).collect()
    assert sorted(str(r["doc_id"]) for r in pieces) == sorted(str(i) for i, _ in BIG)
    joined = ngram_join.join(docs).collect()
    assert sorted(str(r["doc_id"]) for r in joined) == sorted(str(i) for i, _ in BIG)
    assert all(r["component_id"] == r["doc_id"] for r in joined)


# -- 1 sorted-string tables

def test_sstable_round_trip_and_lookup():
    rng = random.Random(1)
    entries = [(None, np.array([9], "<u4"))] + [(i, np.array([rng.randrange(70000) for _ in range(rng.randrange(40))], "<u4")) for i in sorted(rng.sample(range(-10**12, 10**12), 9000))]
    entries.insert(500, entries[500])
    content = b"".join(x + b"\n" for x in sstable.build(iter(entries), 3))
    shard = sstable.Reader.of(content)
    assert (shard.shard, shard.entries) == (3, len(entries)) and len(shard.index[1]) > 3
    assert [(i, v.tolist()) for i, v in shard] == [(i, v.tolist()) for i, v in entries]
    for i, v in rng.sample(entries, 200):
        assert any(np.array_equal(v, x) for x in shard.get(i))
    assert len(shard.get(entries[500][0])) == 2 and shard.get(10**15) == []
    assert sum(shard.may_hold(sstable.key_of(10**13 + i)) for i in range(2000)) < 60
    assert list(sstable.build(iter(()))) == []
    broken = bytearray(content)
    broken[10] ^= 1
    with pytest.raises(ValueError):
        list(sstable.Reader.of(bytes(broken)))


def test_sstable_tables(spark):
    path = shared_dir(spark, "test")
    docs = docs_of(spark, EDGE + [(100 + i, f"text number {i}") for i in range(300)])
    sstable.write(docs, path, P.path("byte_bpe_50k.json"), end_id=2)
    got = sorted(map(tuple, sstable.summary(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    rows = EDGE + [(100 + i, f"text number {i}") for i in range(300)]
    want = sorted(((i, x + b"\x02\0\0\0") for (i, _), x in zip(rows, plainly("byte_bpe_50k.json", [t for _, t in rows]))), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert [g[0] for g in got] == [w[0] for w in want]
    for g in got:
        assert g[1] == start
        start += g[2]
    assert sorted((g[0] or -1, g[2], g[3]) for g in got) == sorted((i or -1, len(x) // 4, zlib.crc32(x)) for i, x in want)
    found = sstable.lookup(spark, path, [5, 150, 9999, None]).collect()
    assert sorted(r["doc_id"] or 0 for r in found) == [0, 5, 5, 150]
    table = sstable.Table(spark, path)
    assert len(table.get(301)) == 1 and 0 < table.bytes_read < sum(size for _, size in table.files)
    empty = shared_dir(spark, "test")
    sstable.write(docs.limit(0), empty, P.path("byte_bpe_50k.json"), end_id=2)
    assert sstable.summary(spark, empty).count() == 0


# -- 2 exact dedup

@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup(spark, keep, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FREQUENT_ROWS", 20)
    rows = EDGE + [(1000 + i, "very frequent") for i in range(500)] + [(2000 + i, f"copy {i % 30}") for i in range(90)] + [(1003, "very frequent")]
    docs = docs_of(spark, rows).withColumn("kept", F.lit("clash"))
    got = exact_dedup.deduplicate(docs, keep=keep).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r["text"] or ""]
        real = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == ((min if keep == "min" else max)(real) if real else None)
        assert r["text_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    kept = [r["text"] or "" for r in got if r["kept"]]
    assert sorted(kept) == sorted(groups)
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0


# -- 3 packing

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2048), max_size=120))
def test_windows_hold_all_items(sizes):
    dealt = packing.windows(sizes)
    assert sorted(i for w in dealt for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 2048 for w in dealt)


def test_differencing_is_balanced():
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]
    rng = random.Random(2)
    sizes = [rng.randrange(1, 400) for _ in range(600)]
    sums = [sum(sizes[i] for i in w) for w in packing.differencing(sizes, 40)]
    assert max(sums) - min(sums) <= 10


def test_packing(spark):
    rng = random.Random(3)
    rows = EDGE + [(100 + i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(900)))) for i in range(400)]
    got = packing.pack(docs_of(spark, rows).coalesce(2), P.path("word_bpe_49k.json"), end_id=1, with_ids=True).collect()
    want = {}
    for (i, _), x in zip(rows, plainly("word_bpe_49k.json", [t for _, t in rows])):
        want.setdefault(i, []).append(x + b"\x01\0\0\0")
    by_sequence = {}
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and len(r["ids"]) == 4 * r["length"] > 0
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert total == sum(len(x) // 4 for xs in want.values() for x in xs)
    assert len(by_sequence) * 2048 < 1.03 * total + 2 * 2048
    for i in (1, 4, 7, 150):
        parts = sorted((r["start"], bytes(r["ids"])) for r in got if r["doc_id"] == i)
        assert b"".join(p for _, p in parts) == want[i][0]
    assert packing.pack(docs_of(spark, rows).limit(0), P.path("word_bpe_49k.json"), end_id=1).count() == 0


# -- 4 preferences

def test_preferences(spark):
    turns = [
        (1, "chosen", 0, "system", "be nice"), (1, "chosen", 1, "user", "hi"), (1, "chosen", 2, "assistant", "hello <|end|>"),
        (1, "rejected", 0, "system", "be nice"), (1, "rejected", 1, "user", "hi"), (1, "rejected", 2, "assistant", "go away"), (1, "rejected", 3, "user", None),
        (2, "chosen", 0, "user", "same"), (2, "rejected", 0, "user", "same"), (3, "chosen", 0, "user", "alone"), (None, "chosen", 0, "user", "x"),
    ]
    df = spark.createDataFrame(turns, "pair_id long, side string, turn long, role string, text string").withColumn("prompt", F.lit(1))
    got = {r["pair_id"]: r for r in preferences.format_pairs(df).collect()}
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert one["n_prefix"] == 2 and one["prompt"] == "<|system|>\nbe nice<|end|>\n<|user|>\nhi<|end|>\n"
    assert [one["chosen"][s["start"] : s["end"]] for s in one["chosen_spans"]] == ["hello < |end|><|end|>\n"]
    assert [one["rejected"][s["start"] : s["end"]] for s in one["rejected_spans"]] == ["go away<|end|>\n"]
    assert one["rejected"].endswith("<|user|>\n<|end|>\n")
    assert got[2]["n_prefix"] == 1 and got[2]["chosen"] == got[2]["rejected"] == ""
    assert got[3]["rejected"] is None and got[3]["prompt"] == "" and "alone" in got[3]["chosen"]
    assert preferences.format_pairs(df.limit(0)).count() == 0


# -- 5 URL rules

URLS = [
    "http://a.net/x", "HTTP://B.Example.NET/en/1?q=/de/", "https://example.net/en", "https://example.net/en/", "http://example.com/de/#a", "http://badexample.com/de/",
    "http://x.org/fr/1", "http://x.org/FR/1", "no scheme/net/", None, "", "http://m.casino-win.example.org/de/1", "http://x.org/casino/win", "http://xcasino.org/", "http://net/",
    "http://net?x", "a://b.org/ads/q/click", "http://x.com/p?u=http://a.net/",
]


def brute_verdict(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c.group().lower(), m.group(1)) if m else ""
    path = m.group(2) if m else ""
    best = max((r for r in url_rules.LISTED if any(
        (host == h or host.endswith("." + h)) and path.startswith("/" + p) for h, _, p in [r.name.partition("/")])), key=lambda r: (len(r.name), r.name), default=None)
    other = max((r for r in url_rules.PATTERNS if re.search(r.regex, host + path)), key=lambda r: (len(r.name), r.name), default=None)
    return host, path, best and best.name, best.action if best else other.action if other else "allow"


@pytest.mark.parametrize("inline", [1000, 0])
def test_url_rules(spark, inline, monkeypatch):
    monkeypatch.setattr(url_rules, "INLINE_RULES", inline)
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS * 3)], "page_id long, url string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, url_rules.LISTED + url_rules.PATTERNS).collect()}
    assert got == {i: brute_verdict(u) for i, u in enumerate(URLS * 3)}
    assert url_rules.judge(pages.limit(0), url_rules.LISTED).count() == 0
    if inline:
        assert {r["verdict"] for r in url_rules.judge(pages, [url_rules.Rule("*net*", "block")]).collect()} == {"allow", "block"}


def test_rule_lists(spark, tmp_path):
    (tmp_path / "list.txt").write_text("! a comment\n[Adblock]\n||bad.example^\n@@||bad.example/good/\n/banner/*\nx.com##.ad\n||odd.example^$script\n\n||bad.example^\n")
    rules = url_rules.read_rules(spark, f"file://{tmp_path}/list.txt")
    assert [(r.pattern, r.action) for r in rules] == [("||bad.example^", "block"), ("||bad.example/good/", "allow"), ("/banner/*", "block")]
    urls = ["http://a.bad.example/x", "http://bad.example/good/x", "http://ok.example/banner/1.png", "http://ok.example/" + "banner" * 20000, None, "http://notbad.example/"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(0, urls[0])], "page_id long, url string")
    got = url_rules.judge(pages, rules).orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["block", "block", "allow", "block", "allow", "allow", "allow"]


def test_rule_tokens():
    assert url_rules.Rule("^casino-win^", "block").tokens == ["casino", "win"]
    assert url_rules.Rule("casino*win^", "block").tokens == []
    assert url_rules.Rule("||net/", "block").tokens == ["net"]


# -- 6 licences

def test_license_scan(spark):
    texts = [None, "", "Released under the MIT License.", "foo\nReleased  under the mit LICENSE\nbar", "All rights reserved.", "x " * 50000,
             "This work is licensed under the\nGNU General Public License, version 3.", "under the MIT sky", license_scan.TEMPLATES["MIT-text"].replace(" ", "\n", 9)]
    got = license_scan.scan(docs_of(spark, list(enumerate(texts))).withColumn("dice", F.lit("clash"))).orderBy("doc_id").collect()
    assert [r["license"] for r in got] == [None, None, "MIT", "MIT", "all-rights-reserved", None, "GPL-3.0", None, "MIT-text"]
    assert got[2]["dice"] == 1.0 and got[0]["n_notices"] == 0
    inside = [
        "(c) 2021 Foo Ltd. All rights reserved. Ask us before you copy any part of it",
        "Foo is licensed under the Apache License, Version 2.0 and may be used by anyone who likes to",
        "a header of this file that goes on for long and is\nreleased under the\nMIT License. and says some more after that for long",
        "All rights reserved.\nBar is released under the MIT License. and this line goes on and on",
        "the rights were reserved and the license of the MIT was released by someone under the sky",
        "two two\nAll rights reserved.\nAll rights reserved.",
    ]
    docs = docs_of(spark, list(enumerate(inside)) + [(0, inside[0])])
    got = license_scan.scan(docs).orderBy("doc_id").collect()
    assert [(r["license"], r["n_notices"]) for r in got] == [
        ("all-rights-reserved", 1), ("all-rights-reserved", 1), ("Apache-2.0", 1), ("MIT", 1), ("all-rights-reserved", 2), (None, 0), ("all-rights-reserved", 2)]
    assert license_scan.scan(docs.limit(0)).count() == 0
    tie = license_scan.scan(docs_of(spark, [(1, "one two three")]), templates={"b": "one two three", "a": "One, two, three"}).first()
    assert tie["license"] == "b" and tie["n_notices"] == 1


def test_license_windows_equal_every_window(spark):
    """Notices with changed words, also at both anchors, inside long lines: as by a window at each word."""
    rng = random.Random(6)
    names, texts = sorted(license_scan.TEMPLATES), []
    for i in range(120):
        words = license_scan.TEMPLATES[names[i % len(names)]].lower().replace("-", " ").split()
        for _ in range(rng.randrange(1 + len(words) // 8)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = rng.choice([[], ["other"], ["one", "more"]])
        texts.append(" ".join(rng.choices("abc", k=rng.choice([0, 3, 40])) + words + rng.choices("xyz", k=rng.choice([0, 40]))))
    lost = re.sub("[^a-z0-9]+", " ", license_scan.TEMPLATES["MIT-text"].lower())
    for _, pair, _, _ in [a for a in license_scan.anchors(license_scan.TEMPLATES) if a[0] == "MIT-text"]:
        lost = lost.replace(pair, pair.replace(" ", " quite "))
    texts.append("a " * 150 + lost + " b" * 150)
    sets = {n: set(license_scan.bigrams(t)) for n, t in license_scan.TEMPLATES.items()}
    length = {n: words for n, _, _, _, words in license_scan.prefixes(license_scan.TEMPLATES)}

    def dice(words, name):
        own = [f"{a} {b}" for a, b in zip(words, words[1:])]
        return 2 * len(set(own) & sets[name]) / (len(own) + len(sets[name])) if own else 0

    got = {r["doc_id"]: r["dice"] for r in license_scan.scan(docs_of(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
        line = max(dice(words, n) for n in sets)
        best = max([0] + [dice(words[k : k + length[n]], n) for n in sets for k in range(len(words))])
        if max(line, best) >= 0.8:
            assert got[i] is not None and got[i] >= (line if line >= 0.8 else best) - 1e-12, (i, text)
    assert got[120] is not None and got[120] >= 0.8


# -- 7 SentencePiece

def test_sentencepiece_parity_and_round_trip(spark):
    b = sentencepiece_bridge.Bridge(P.path("piece_bpe_32k.model"), generation=50)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcXYZ éß .,!?'\n\t  3½中áΣ <s></s>▁") for _ in range(rng.randint(0, 40))) for _ in range(600)] + [None, ""]
    texts += ["two words and more words", "two words, and more"]
    for text, (raw, same, back) in zip(texts, b.encode(texts)):
        ids = np.frombuffer(raw, "<u4").tolist()
        assert same and ids == b.origin.encode(text or "")
        assert back == (b.decode([ids])[0] == (text or ""))
    got = sentencepiece_bridge.encode(docs_of(spark, EDGE), P.path("piece_bpe_32k.model"), with_ids=True).collect()
    assert len(got) == len(EDGE) and all(r["parity"] and r["round_trip"] for r in got)


def test_pieces_are_checked_in_lines_and_faults_are_found_one_by_one():
    b = sentencepiece_bridge.Bridge(P.path("piece_bpe_32k.model"), cache_bytes=100_000)
    origin, asked = b.origin, []

    class Origin:
        def encode(self, texts, **more):
            asked.extend(texts)
            return [ids + [5] * ("w777é" in t.split(" ")) for t, ids in zip(texts, origin.encode(texts, **more))]

    b.origin = Origin()
    texts = [" ".join(f"w{i}é" + ["", ".\nX", "\u3000½"][i % 3] for i in range(at, at + 100)) for at in range(0, 4000, 100)] + ["", "\n", "w1é w777é"]
    for text, (raw, same, back) in zip(texts, b.encode(texts, block_chars=8000)):
        assert np.frombuffer(raw, "<u4").tolist() == origin.encode(text)
        assert back and same == ("w777é" not in text.split(" "))
    assert len(asked) < 1000 and b.odd == {"w777é"}  # of 4,002 different pieces
    assert b.spent == sum(sentencepiece_bridge.ENTRY_BYTES + len(p) + len(raw) for p, raw in b.young.items()) and len(b.old) + len(b.young) < 2000


def test_unigram_models_are_rebuilt():
    spec = sentencepiece_bridge.Spec(pieces=[("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁ab", -1.5, 1), ("a", -3.0, 1)], kind=1)
    assert sentencepiece_bridge.build(spec).encode("ab a", add_special_tokens=False).ids == [3, 1]


# -- 8 quality rules

def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def test_quality_measures(spark):
    rng = random.Random(6)
    texts = [t for _, t in EDGE] + [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + rng.choice(["", "\n#$ |x|\n#$ |x|\n\n\n", "\x0b\x0ca\r\n"]) for _ in range(150)]
    docs = docs_of(spark, list(enumerate(texts))).withColumn("n_words", F.lit("clash"))
    got = quality_rules.measured(docs).select("doc_id", *quality_rules.COUNTS).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {i: brute_quality(t) for i, t in enumerate(texts)}


def test_binomial_tail():
    assert quality_rules.binomial_tail(0, 10, 0.5) == pytest.approx(0.5**10)
    assert quality_rules.binomial_tail(10, 10, 0.3) == pytest.approx(1.0)
    assert quality_rules.binomial_tail(2, 4, 0.5) == pytest.approx(11 / 16)


def test_cutoffs_keep_the_risk(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    good = [(i, " ".join(word() for _ in range(30))) for i in range(4000)]
    bad = [(10000 + i, " ".join(word() + "$$$" for _ in range(30))) for i in range(200)]
    docs = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(5, None), (99999, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, labels, carry=["doc_id"]).collect()}
    assert sum(not got[i] for i, _ in good) <= 0.02 * len(good) and not any(got[i] for i, _ in bad)
    few = quality_rules.judge(docs, labels.limit(50)).collect()
    assert all(r["kept"] != r["base_failed"] for r in few)
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


def test_small_strata_get_cutoffs(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda end: " ".join(word() + end for _ in range(30))
    # One stratum of 500 good texts, and twenty of 40 that are shown something only together.
    rows = [(i, text(""), "de" if i < 500 else f"x{i % 20}", 1) for i in range(1300)]
    rows += [(10000 + i, text("$$$"), "de" if i < 50 else f"x{i % 20}", 0) for i in range(150)]
    # As many good as bad texts shout: no cutoff may be set on that.
    rows += [(20000 + i, text("!"), "de", i % 2) for i in range(60)]
    docs = spark.createDataFrame([(i, t, v, "s", len(t)) for i, t, v, _ in rows], DOC)
    labels = spark.createDataFrame([(i, q) for i, _, _, q in rows], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, labels, carry=["doc_id"]).collect()}
    assert not any(got[10000 + i] for i in range(150))
    assert all(got[i] for i, _, _, q in rows if q == 1)
    # A thousand copies of one good text are one vote: too little to set any cutoff.
    copies = spark.createDataFrame([(i, "a b c d e f g h i j k", "de", "s", 21) for i in range(1000)] + [(2000 + i, text("$$$"), "de", "s", 9) for i in range(50)], DOC)
    votes = spark.createDataFrame([(i, 1) for i in range(1000)] + [(2000 + i, 0) for i in range(50)], "doc_id long, quality int")
    assert all(r["kept"] != r["base_failed"] for r in quality_rules.judge(copies, votes).collect())


# -- 9 toxicity

def test_toxicity(spark):
    rng = random.Random(9)
    plain = ["".join(rng.choice("aeioubdgk") for _ in range(5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(1600):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        kind = i % 8
        words += {0: ["insult", "people"], 1: ["insult"], 2: ["people"]}.get(kind, [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind == 0)))
    docs = docs_of(spark, rows + [(9000, None), (9001, "")]).withColumn("score", F.lit("clash"))
    frame = spark.createDataFrame(labels + [(3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.judge(docs, frame).collect()}
    held = [(i, y) for i, y in labels if got[i]["held_out"]]
    assert {i for i, _ in held} == {i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2}
    # Neither word alone is toxic, only the pair: what a linear model cannot tell.
    assert sum(got[i]["predicted"] == y for i, y in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    none = toxicity.judge(docs, frame.limit(0)).collect()
    assert len({r["score"] for r in none}) == 1
    assert toxicity.judge(docs.limit(0), frame).count() == 0


def test_toxicity_driver_gets_features_only(spark, monkeypatch):
    """Terms that are no features stay on the executors, and the model is that of the whole texts."""
    texts = [(i, f"{'vile' if i % 3 == 0 else 'kind'} " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}" for k in range(26))) for i in range(200)]
    docs, labels = docs_of(spark, texts), spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in texts], "doc_id long, toxic int")
    seen, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda found, *a: seen.extend(found) or fit(found, *a))
    model = toxicity.train(docs, labels)
    learnt = [(i, t) for i, t in texts if zlib.crc32(str(i).encode()) % 4 != 2]
    whole = [np.array(sorted({b for w in set(t.split()) for b in toxicity.terms(w)})) for _, t in learnt]
    y = np.array([int(i % 3 == 0) for i, _ in learnt])
    want = fit(whole, y, y.mean())
    assert set(model.buckets) == set(want.buckets) >= set(toxicity.terms("vile")) | set(toxicity.terms("kind"))
    assert (model.bias, model.weights.tolist(), model.vectors.tolist()) == (want.bias, want.weights.tolist(), want.vectors.tolist())
    assert len(seen) == len(learnt) and {int(b) for d in seen for b in d} == set(want.buckets.tolist())


def test_toxicity_scores_equal_the_pairwise_sum(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["insult", "people", "garden", "river", "stone", "bread"]) + rng.choice(["", "s", "like"]) for _ in range(rng.randrange(1, 9)))) for i in range(400)]
    rows += [(7, "insult people"), (7, "river"), (None, "insult people"), (500, "river stone " * 40000), (501, None)]
    labels = spark.createDataFrame([(i, int("insult" in t and "people" in t)) for i, t in rows[:400]], "doc_id long, toxic int")
    docs = docs_of(spark, rows)
    model = toxicity.train(docs, labels)
    place = {int(b): k for k, b in enumerate(model.buckets)}
    assert place

    def brute(text):
        found = sorted({place[b] for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for b in toxicity.terms(w) if b in place})
        z = model.bias + sum(model.weights[f] for f in found)
        z += sum(float(model.vectors[f] @ model.vectors[g]) for k, f in enumerate(found) for g in found[k + 1 :])
        return 1 / (1 + np.exp(-min(30, max(-30, z))))

    got = toxicity.judge(docs, labels).select("text", "score").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(brute(r["text"]), abs=1e-9)
    # No more rows than the bound are learnt from, however often documents repeat an identifier.
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 20)
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 30)
    monkeypatch.setattr(toxicity, "fit", lambda found, *a: seen.append(len(found)) or fit(found, *a))
    toxicity.train(docs.unionByName(docs).unionByName(docs), labels)
    assert seen == [50]


# -- 10 n-gram join

def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({65 + k: 97 + k for k in range(26)}))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a, x in enumerate(ids):
        for y in ids[a + 1 :]:
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                p, q = find(x), find(y)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_ngram_join(spark):
    rng = random.Random(10)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnopqr") + str(rng.randrange(30))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, "w " * 20000)]
    shared = " ".join(word() for _ in range(60))
    for group in range(25):
        base = [word() for _ in range(rng.randrange(6, 120))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((100 + len(rows), " ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    for _ in range(30):  # a common passage with a little or a lot around it
        rows.append((100 + len(rows), shared + " " + " ".join(word() for _ in range(rng.choice([2, 8, 20, 40])))))
    rng.shuffle(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs_of(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_ngram_join_edges(spark):
    assert ngram_join.join(docs_of(spark, EDGE).limit(0)).count() == 0
    got = [(r["doc_id"], r["component_id"]) for r in ngram_join.join(docs_of(spark, EDGE)).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (5, 5), (6, 5), (None, None), (7, 7)], key=str)


def test_shingle_filters_lose_no_pair():
    rng = random.Random(11)
    for _ in range(300):
        a = np.unique(np.array([rng.randrange(80) for _ in range(rng.randrange(1, 60))], "uint64"))
        b = np.unique(np.array([*rng.sample(a.tolist(), max(1, len(a) - rng.randrange(8))), rng.randrange(80)], "uint64"))
        both = len(np.intersect1d(a, b))
        assert ngram_join.similar(a, b) == (100 * both >= 75 * (len(a) + len(b) - both))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (300, 100), (7, 7), (500, 499)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[300] == got[200] == got[100] == 100 and got[500] == 499


# -- pipeline

def test_near_copies_go_without_a_shuffle_of_all_texts(spark):
    import corpus_pipeline

    rng = random.Random(12)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(400))) for i in range(600)]
    rows += [(1000, rows[5][1] + " end"), (1001, rows[5][1]), (1001, rows[6][1]), (None, rows[5][1])]
    docs = docs_of(spark, rows).repartition(4).localCheckpoint()
    store = spark.sparkContext._jsc.sc().statusStore()

    def shuffled():
        empty = spark.sparkContext._jvm.java.util.ArrayList()
        stages = store.stageList(empty, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), empty)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as in a table with many near copies
    try:
        out = corpus_pipeline.drop_near_copies(spark, docs, "")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        start = shuffled()
        left = sorted(str(r["doc_id"]) for r in out.collect())
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert left == sorted([str(i) for i in range(600) if i != 6] + ["None"])
    assert shuffled() - start < sum(len(t) for _, t in rows) / 10


def test_pipeline_stages(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns, name
        before, after = {r[0] for r in docs.select("doc_id").collect()}, {r[0] for r in out.select("doc_id").collect()}
        assert after <= before
        if name == "exact_dedup":
            texts = [r[0] for r in out.select("text").collect()]
            assert len(texts) == len(set(texts))
        if name == "ngram_jaccard_join":
            rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
            assert after == {i for i, (_, c) in brute_components(rows).items() if i == c}
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
    assert corpus_pipeline.run(spark, d).count() > 0


def test_pipeline_stages_on_edge_cases(spark, tmp_path):
    import corpus_pipeline

    where = f"file://{tmp_path}"
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{where}/labels.parquet")
    prose = "one two three four five six seven eight nine ten eleven twelve"
    rows = EDGE + [(20, prose), (21, prose), (21, prose), (22, prose + " thirteen"), (None, prose), (2**60 + 1, "another text of more than ten words that stands all alone in here")]
    docs = docs_of(spark, rows).withColumns({"kept": F.lit("clash"), "score": F.lit(1), "license": F.lit(None).cast("string")})
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, where)
        left[name] = sorted(str(r["doc_id"]) for r in out.collect())
        if name != "packing":
            assert out.columns == docs.columns and out.schema["kept"].dataType.simpleString() == "string"
        assert stage(spark, docs.limit(0), where).count() == 0
    ids = sorted(str(i) for i, _ in rows)
    assert left["toxicity"] == ids  # too few labels to tell any text from the others
    assert left["quality_rules"] == sorted(["20", "21", "21", "22", "None", str(2**60 + 1)])
    # Of equal texts the row with the smallest identifier stays.
    assert left["exact_dedup"] == sorted(["1", "3", "4", "5", "7", "20", "22", "None", str(2**60 + 1)])
    # Rows without identifier link with nothing; 20, 21 and 22 are one group.
    assert left["ngram_jaccard_join"] == sorted(["1", "2", "3", "4", "5", "5", "7", "20", "None", "None", str(2**60 + 1)])
    assert set(left["packing"]) == set(ids)


def test_packing_leaves_little_in_idle_workers(spark):
    rng = random.Random(5)
    texts = [(i, " ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(10_000))) for i in range(50)]
    packing.pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), P.path("word_bpe_49k.json"), end_id=1).count()

    def held(batches):
        from placeweave.llm import encoding

        for _ in batches:
            time.sleep(1)  # so that each idle worker gets a task
            caches = [c for e in encoding._ENCODERS.values() for c in (e.words, e.pieces)]
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([sum(c.spent + getattr(c.older, "spent", 0) for c in caches)], pa.int64())})

    most = max(r["bytes"] for r in spark.range(0, 4, 1, 4).mapInArrow(held, "bytes long").collect())
    assert most < 64 << 20
