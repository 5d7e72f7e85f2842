"""Operators against brute force on small tables, with nulls, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
import zstandard
from tokenizers import Tokenizer

from plumbline.llm import bpe, components, forest, licenses, packing, sharding, simhash, sketch, substrings, toxicity, warc

from .conftest import words

PATH = public_tokenizers.path("word_bpe_49k.json")
SPACE = r"[\x20\x09-\x0D]+"


def split(text):
    return [w for w in re.split(SPACE, text or "") if w]


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]


# -- BPE

def test_bpe_equals_library(odd, none):
    lib = Tokenizer.from_file(PATH)
    got = Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in bpe.decode(bpe.encode(odd, PATH), PATH).collect())
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"], np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)] += 1
    assert got == want
    assert bpe.encode(none, PATH).count() == 0


def test_bpe_forgetting_changes_nothing():
    with open(PATH) as f:
        spec = f.read()
    texts = [" ".join(words(i, 50)) for i in range(20)]
    assert bpe.Bpe(spec, memory=60).encode(texts) == bpe.Bpe(spec).encode(texts)


# -- packing

def test_pieces_and_sequences(odd, none):
    lib = Tokenizer.from_file(PATH)
    pieces = packing.token_pieces(odd, PATH, tokens=64)
    got = packing.pack(pieces, tokens=64, group=20).toPandas()
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        ids = [*lib.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 64)):
            want[r["doc_id"], k, at, np.array(ids[at : at + 64], "<u4").tobytes()] += 1
    assert Counter((None if pd.isna(d) else int(d), p, s, bytes(i)) for d, p, s, i in zip(got.doc_id, got.piece, got.start, got.ids)) == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.length.sum() <= 64 and (g.offset == g.length.cumsum() - g.length).all()
    assert packing.pack(packing.token_pieces(none, PATH)).count() == 0


def test_packing_moves_lengths_only_and_looks_chunks_up_once(spark, monkeypatch):
    """Token ids stay out of the groups, and a batch asks the memory for each of its chunks once."""
    docs = spark.createDataFrame([(i, "aa bb cc " * 50) for i in range(30)], "doc_id long, text string")
    grouped = packing.pack(packing.token_pieces(docs, PATH), group=10)._jdf.queryExecution().optimizedPlan().toString()
    assert all("ids" not in line for line in grouped.splitlines() if "FlatMapGroupsInPandas" in line)
    asked, look = [], packing.pc.index_in
    monkeypatch.setattr(packing.pc, "index_in", lambda texts, **kw: (asked.append(len(texts)), look(texts, **kw))[1])
    chunks = packing.Chunks(open(PATH).read())
    monkeypatch.setattr(packing, "MEMORY", 4)
    for words in (["aa", "bb", "aa"] * 20, ["cc", "aa"] * 20, ["dd", "ee", "ff", "ff"], []):  # the third empties the memory
        texts = packing.pa.array(words, packing.pa.string())
        at = chunks.numbers(texts)
        got = [chunks.ids[chunks.first[k] : chunks.first[k] + chunks.size[k]].tolist() for k in at]
        assert got == [chunks._encode(w) for w in words]
    assert asked == [2, 2, 3, 0]


@pytest.mark.parametrize("by", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(by):
    r = random.Random(1)
    lengths = np.array([r.randint(1, 100) for _ in range(3000)])
    seq, off = packing.best_fit(lengths, 100, 8, 10_000.0, by, (1.0, 0.01, 0.01))
    load, count = np.bincount(seq, lengths), np.bincount(seq)
    cost = np.bincount(seq, lengths.astype(float) ** 2)
    assert load.max() <= 100 and count.max() <= 8 and cost.max() <= 10_000
    seq, _ = packing.best_fit(lengths, 100, 100, 10_000.0, by, (1.0, 0.001, 0.001))
    assert seq.max() + 1 <= math.ceil(lengths.sum() / 100) * (1.02 if by == "norm" else 1.1)


# -- WARC

def test_warc_round_trip(spark):
    data = [(1, "u1", "a"), (2, None, "a"), (3, "u3\r\nX: y", None), (4, "u4", ""), (5, "u5", "é" * 70000), (None, "u6", "a"), (7, "u7", "b"), (7, "u7", "b"), (None, None, "alone")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("sha", warc.F.lit(1))
    got = Counter(rows(warc.round_trip(pages), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    want = Counter()
    for page, _, html in data:
        body = (html or "").encode()
        top = max((p for p, _, h in data if (h or "") == (html or "") and p is not None), default=None)
        revisit = top is not None and top != page
        want[page, len(body), warc.digest(body), "revisit" if revisit else "response", top if revisit else None] += 1
    assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0
    small = warc.round_trip(pages, least=2)
    assert small.where("payload_bytes < 2 and record_type = 'revisit'").count() == 0


def test_warc_finds_damage():
    record = warc.build(1, "u", b"payload", None, "1970-01-01T00:00:00Z")
    lead, trained = warc.dictionary_frame([warc.build(i, f"http://x/{i}", " ".join(words(i, 80)).encode(), None, "d") for i in range(200)], 4096)
    assert trained is not None
    frame = zstandard.ZstdCompressor(dict_data=trained).compress(record)

    def read(raw):
        at = iter([raw[i : i + 50] for i in range(0, len(raw), 50)])
        return list(warc.frames(lambda n: next(at, b"")))

    assert read(lead + frame + frame) == [record, record]
    for bad in (frame, lead + frame[:-5], lead[:-3], b"\x00\x01\x02\x03" + frame):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            read(bad)
    assert warc.page_record(record)[1:3] == ("response", 1)
    for wrong in (
        record[:-1], record + b"x", record.replace(b"WARC/1.1", b"WARC/9.9"), record.replace(b"WARC-Date: ", b"Date: "), record.replace(b"payload\r\n\r\n", b"payloaX\r\n\r\n"),
        re.sub(rb"msgtype=response\r\nContent-Length: \d+", b"msgtype=response\r\nContent-Length: 3", record), record.replace(b"WARC-Type: response", b"WARC-Type response"),
    ):
        with pytest.raises(ValueError):
            warc.page_record(wrong)


# -- sharding

def test_shards(odd, none, docs):
    got = sharding.shard(odd, 3).toPandas()
    assert len(got) == odd.count() and sorted(got["size"]) == sorted(len((r["text"] or "").encode()) + 1 for r in odd.select("text").collect())
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    got = sharding.shard(docs, 8).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    longest = got["size"].max()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2 * longest + 0.01 * sizes.mean()
    assert sharding.shard(none, 8).count() == 0


def six_bytes(x):
    return -1.0 if x is None else float(int.from_bytes(x.encode()[:6].ljust(6, b"\0"), "big"))


def test_shards_are_nodes_of_a_tree(docs):
    """Every cut is along the widest dimension of its node, in the order of the keys, near the weighted median; copies share a shard."""
    got = sharding.shard(docs.where("doc_id is not null"), 8).toPandas().merge(docs.toPandas(), on="doc_id")
    got["text"] = got["text"].fillna("")
    got["c0"], got["c1"], got["c2"] = got["n_chars"].astype(float), got["source"].map(six_bytes), got["lang"].map(six_bytes)
    for c in ("c0", "c1", "c2"):
        got[c] = got.groupby("text")[c].transform("min")
    unit = {c: max(got[c].max() - got[c].min(), 1e-300) for c in ("c0", "c1", "c2")}
    weight = got.groupby("text")["size"].sum()
    nodes, torn = [(0, 8)], 0
    while nodes:
        first, k = nodes.pop()
        if k == 1:
            continue
        half = (k + 1) // 2
        node = got[(got["shard"] >= first) & (got["shard"] < first + k)]
        left, right = node[node["shard"] < first + half], node[node["shard"] >= first + half]
        wide = max(unit, key=lambda c: (node[c].max() - node[c].min()) / unit[c])
        assert left[wide].max() <= right[wide].min()
        heaviest = weight[list(set(left["text"]) | set(right["text"]))].max()
        assert abs(left["size"].sum() - node["size"].sum() * half / k) <= heaviest
        cut = set(left["text"]) & set(right["text"])
        torn += len(cut)
        assert len(cut) <= 1 and all(weight[t] > sharding.SLACK * got["size"].sum() / 8 for t in cut)
        nodes += [(first, half), (first + half, k - half)]
    assert (got.groupby("text")["shard"].nunique() > 1).sum() <= torn


def test_copies_with_other_metadata_share_a_shard(spark):
    data = [(i, " ".join(words(i % 500, 30)), ["en", "fr", "de", "es"][i % 4], f"s{i % 7}", i * 3 % 1000) for i in range(2000)]
    got = sharding.shard(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"), 4, slack=0.05).toPandas()
    assert (got.groupby("text_crc32")["shard"].nunique() == 1).all()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 4 and sizes.max() <= 1.1 * sizes.min()


def test_hot_text_with_other_metadata(spark):
    """A third of all rows is one text: looked up by broadcast and cut by row number where balance asks for it."""
    data = [(i, "hot" if i % 3 == 0 else f"text {i % 400}", ["en", "fr"][i % 2], f"s{i % 5}", i % 90) for i in range(3000)]
    got = sharding.shard(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"), 4).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(got) == 3000 and sorted(got["doc_id"]) == list(range(3000)) and sizes.max() <= 1.05 * sizes.min()


def test_shards_split_a_hot_text(spark):
    df = spark.createDataFrame([(1, "same text", "en", "s", 9)] * 90, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["count"] for r in sharding.shard(df, 3).groupBy("shard").count().collect()) == [30, 30, 30]


# -- substrings

def brute_cut(data, width):
    least = {}
    for i, t in data:
        w = split(t)
        for p in range(len(w) - width + 1):
            k = tuple(w[p : p + width])
            if i is not None:
                least[k] = min(i, least.get(k, i))
    out = Counter()
    for i, t in data:
        w = split(t)
        gone = set()
        for p in range(len(w) - width + 1):
            k = tuple(w[p : p + width])
            if i is not None and least[k] < i:
                gone.update(range(p, p + width))
        out[i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)] += 1
    return out


@pytest.mark.parametrize("group", [1_000_000, 7])
def test_substrings(odd, none, group):
    data = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = substrings.dedup(odd, group=group)
    assert got.columns == [*odd.columns, "n_words", "n_removed"]
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], " ".join(split(r["text"]))) for r in got.collect()) == brute_cut(data, 13)
    assert got.where("doc_id = 5 and text is null").count() == 1
    assert substrings.dedup(none).count() == 0


def test_word_symbols_in_blocks(monkeypatch):
    text = " ".join(words(9, 400)).encode()
    whole = substrings.symbols(text)
    monkeypatch.setattr(substrings, "BLOCK", 64)
    assert all(np.array_equal(a, b) for a, b in zip(whole, substrings.symbols(text)))
    assert len(set(whole[2].tolist())) == len(set(text.split()))


# -- SimHash

def fingerprint(text, n):
    w = (text or "").encode().lower().split()
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("most", [2048, 2])
def test_simhash_components(odd, none, most):
    got = simhash.near_classes(odd, most=most).collect()
    data = [(r["doc_id"], fingerprint(r["text"], 3)) for r in odd.select("doc_id", "text").collect()]
    group = {f: {f} for _, f in data}
    for f in list(group):
        for g in list(group):
            if (f ^ g).bit_count() <= 3 and group[f] is not group[g]:
                group[f] |= group[g]
                for x in group[g]:
                    group[x] = group[f]
    least = {f: min((i for i, g in data if g in group[f] and i is not None), default=None) for _, f in data}
    assert Counter((r["doc_id"], int.from_bytes(r["fp"], "little"), r["component"]) for r in got) == Counter((i, f, least[f]) for i, f in data)
    assert simhash.near_classes(none).count() == 0


@pytest.mark.parametrize("most", [2048, 16])
def test_links_miss_nothing(spark, most):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(30)]
    every = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(12)}
    df = spark.createDataFrame([(bytearray(x.to_bytes(8, "little")),) for x in every], "fp binary")
    got = components.components(simhash.links(df, 3, simhash.halves_layout(), 64, most))
    root = {int.from_bytes(a, "little"): bytes(b) for a, b in rows(got, "node", "root")}
    for x in every:
        for y in every:
            if (x ^ y).bit_count() <= 3 and x != y:
                assert root[x] == root[y]
    for x, b in root.items():
        assert any(root[y] == b and 0 < (x ^ y).bit_count() <= 3 for y in every if y in root)


def test_keep_one(odd, none):
    got = simhash.keep_one(odd)
    assert got.columns == odd.columns
    kept = [r["doc_id"] for r in got.collect()]
    assert {1, 8, 9, 10, 16, 18, 20} <= set(kept) and not {2, 3, 19, 21} & set(kept)
    assert kept.count(9) == 1
    assert simhash.keep_one(none).count() == 0


def test_alike_spans_what_is_similar():
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 40, 200)
    sets = [np.unique(np.where(r.random(200) < r.choice([0.03, 0.1, 0.2]), r.integers(0, 1 << 40, 200), base)) for _ in range(60)] + [np.empty(0, np.int64)]
    near = [(i, j) for i in range(61) for j in range(i) if len(sets[i]) and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]

    def groups(pairs):
        root = list(range(61))
        for a, b in pairs:
            root = [root[a] if x == root[b] else x for x in root]
        return {frozenset(k for k in range(61) if root[k] == x) for x in root}

    every, one, two = np.arange(61), np.arange(30), np.arange(30, 61)
    assert 0 < len(near) < 1770
    assert groups(zip(*simhash.alike(sets, every, every, 0.8))) == groups(near)
    assert groups(p for x, y in [(one, one), (one, two), (two, two)] for p in zip(*simhash.alike(sets, x, y, 0.8))) == groups(near)


def test_copies_in_a_family_of_templates(spark):
    """Variants at 0.7 of one text that each have a copy at 0.9: fourteen related documents, of which seven stay."""
    base, data = words(900, 300), []
    for v in range(7):
        w = list(base)
        for k in range(10):
            w[7 + 29 * k + v] = f"variant{v}x{k}"
        data += [(v, " ".join(w)), (100 + v, " ".join([*w[:150], "edited", *w[151:]]))]
    layout = simhash.sampled_layout(128, 2, 4)  # cells of more than four members
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string"), layout=layout).collect()}
    assert kept == set(range(7))


def test_equal_fingerprints_are_verified(spark):
    """A line repeated 200 times decides every vote of two documents that share nothing else; each has a near copy of its own."""
    line = words(910, 13)
    data = []
    for v in range(2):
        own = words(911 + v, 100)
        data += [(v, " ".join(line * 200 + own)), (10 + v, " ".join(line * 200 + [*own, "edited"]))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    layout = simhash.sampled_layout(128, 16, 20)
    got = {r["doc_id"]: r["component"] for r in simhash.near_classes(df, 5, 27, layout, 128, similarity=0.8).collect()}
    assert got == {0: 0, 1: 1, 10: 0, 11: 1}


def test_near_copies_by_sets_are_all_found(spark):
    """Pairs of just over 0.8, and a pair of sets over 0.95 whose repeats put the fingerprints far apart."""
    data = []
    for v in range(120):
        w = words(1000 + v, 240)
        e = list(w)
        for k in (20, 70, 120, 170, 220):
            e[k] = f"edited{v}x{k}"
        data += [(v, " ".join(w)), (1000 + v, " ".join(e))]
    line, own = words(990, 12), words(991, 300)
    data += [(500, " ".join([*own, *line])), (1500, " ".join([*own, *line * 60]))]
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert kept == {*range(120), 500}


# -- licences

def test_licences(odd, none):
    got = {r["doc_id"]: r for r in licenses.scan(odd).where("doc_id is not null").collect()}
    mit, many, empty = got[14], got[15], got[5]
    assert (mit["base_labels"], mit["labels"], mit["n_base"], mit["first_word"]) == ("mit", "mit", 1, 1)
    assert many["base_labels"] == "apache-2,cc-by-nc,mit" and many["n_base"] == 3 and (many["first_word"], many["last_word"]) == (3, 14)
    assert (empty["n_words"], empty["n_base"], empty["labels"], empty["score"], empty["first_word"]) == (0, 0, "", 0.0, None)
    assert got[16]["labels"] == "" and 0 < mit["score"] <= 1
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(none).count() == 0


def test_licence_notice_without_base_phrase(spark):
    text = "noise words first. This work is licensed under the GNU General Public License, version 3. and more"
    df = spark.createDataFrame([(1, text), (2, "general words about a public licence, version 3 of the text")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert "gpl-3" in got[1]["labels"].split(",") and got[1]["n_base"] == 0 and got[1]["score"] == 1.0 and got[2]["labels"] == ""


def test_every_notice_of_a_file(spark):
    notices = [t for t in licenses.TEMPLATES if t.label in ("bsd", "gpl", "mpl-2", "cc-by", "gpl-3")]
    scattered = "foundation attribution mozilla redistribution creative permission obtaining commons software binary"
    data = [(1, " filler words between. ".join(t.text for t in notices)), (2, f"{notices[0].text} and {notices[1].text}"), (3, f"{scattered} {notices[0].text} {scattered}")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert {t.label for t in notices} <= set(got[1]["labels"].split(",")) and got[1]["score"] == 1.0
    assert {notices[0].label, notices[1].label} <= set(got[2]["labels"].split(","))
    assert notices[0].label in got[3]["labels"].split(",")


def brute_licences(texts, templates=licenses.TEMPLATES, rare=licenses.RARE, need=licenses.VOTES):
    """Per text: base places by label, and (label, place, share) of every template at every place."""
    rows = [[w for w in re.split(licenses.BREAK, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] for t in texts]
    vocabulary = {w for t in templates for w in t.words}
    df = {w: sum(w in set(r) for r in rows) for w in vocabulary}
    ranked = sorted(vocabulary, key=lambda w: (-math.log((len(rows) + 1) / (df[w] + 1)), w))
    out = []
    for r in rows:
        has = set(r)
        base = {label: [i for i in range(len(r)) if r[i : i + len(p.split())] == p.split()] for p, label in licenses.BASE.items()}
        picked = {w for t in templates if all(w in has for _, p in t.places() for w in p) for w in [w for w in ranked if w in has and w in t.words][:rare]}
        found = []
        for t in templates:
            for at in range(-len(t.words), len(r)):
                same = [0 <= at + q < len(r) and r[at + q] == w for q, w in enumerate(t.words)]
                votes = sum(s and w in picked for s, w in zip(same, t.words))
                if votes >= need and all(all(same[q + k] for k in range(len(p))) for q, p in t.places()):
                    found.append((t.label, at, sum(same) / len(same)))
        out.append((len(r), base, found))
    return out


def licence_texts():
    r, full = random.Random(11), [t.text for t in licenses.TEMPLATES]
    filler = words(21, 40) + ["the", "of", "software", "license", "public", "gnu", "copyright", "notice", "permission", "version", "by", "nc", "cc"]
    texts = [None, "", " \n ", *full, *list(licenses.BASE), "UNDER the MIT-License, cc by\u00e9 nc cc.by.nc"]
    for k in range(40):
        parts = [" ".join(r.choices(filler, k=r.randint(0, 60))) for _ in range(4)]
        notice = r.choice(full).split()
        if k % 2:
            notice[r.randrange(len(notice))] = r.choice(filler)
        if k % 5 == 0:
            notice = notice[r.randint(0, 5) : len(notice) - r.randint(0, 5)]
        texts.append(" ".join([parts[0], *notice, parts[1], r.choice(full), parts[2], r.choice(list(licenses.BASE)), parts[3]]))
    return texts + texts[:4]


def test_licences_equal_brute_force(spark):
    texts = licence_texts()
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    partial = 0
    for i, (n, base, found) in enumerate(brute_licences(texts)):
        r, places = got[i], [p for at in base.values() for p in at]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted(k for k, at in base.items() if at))
        assert sorted(map(tuple, r["found"])) == sorted((label, at) for label, at, _ in found)
        assert r["labels"] == ",".join(sorted({k for k, at in base.items() if at} | {x[0] for x in found}))
        assert r["score"] == pytest.approx(max((x[2] for x in found), default=0.0))
        partial += any(x[2] < 1 for x in found)
    assert partial > 10


# -- sketches

def brute_sketch(text):
    w = split(text)
    hashes = []
    for i in range(max(0, len(w) - 5) + 1 if w else 0):
        h = 42
        for x in w[i : i + 5]:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        hashes.append(h >> 1)
    return sorted({h for h in hashes if h < (1 << 63) // 8} or {min(hashes)}) if hashes else []


@pytest.mark.parametrize("bucket", [16 << 20, 500])
def test_sketches(odd, none, bucket, monkeypatch):
    ask = sketch.with_next
    monkeypatch.setattr(sketch, "with_next", lambda *a: ask(*a, bucket_bytes=bucket))
    frame = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in sketch.edited_sketches(frame).collect()}
    data = sorted((r["doc_id"], r["text"] or "") for r in frame.select("doc_id", "text").collect())
    assert len(got) == len(data)
    for (i, t), (_, nxt) in zip(data, [*data[1:], data[0]]):
        k = len(t) // 4
        edited = t[: len(t) - k] + nxt[:k]
        r = got[i]
        assert (r["n_chars"], r["edited"], r["sketch"], r["edited_sketch"], r["next_sketch"]) == (len(t), edited, brute_sketch(t), brute_sketch(edited), brute_sketch(nxt))
    assert sketch.edited_sketches(odd).count() == odd.count()
    assert sketch.edited_sketches(none).count() == 0


# -- toxicity

def test_chain_on_held_out_rows(spark, none):
    r = random.Random(5)
    bad = ["vile", "filth", "scumbag"]
    data, labels = [], []
    for i in range(900):
        toxic, poor = int(r.random() < 0.3), int(r.random() < 0.3)
        w = words(r.randint(0, 40), 30) + (r.sample(bad, 2) if toxic else []) + (["!!!", "buy", "now"] if poor else [])
        data.append((i, " ".join(w), toxic, poor))
        if i < 600:
            labels.append((i, 1 - poor, toxic))
    labels += [(None, 1, 1), (5000, 1, 1), (3, None, 1)]
    df = spark.createDataFrame([d[:2] for d in data] + [(None, None)], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.train(df, known, toxicity.corpus_categories())
    got = {x["doc_id"]: x for x in chain.score(df).collect()}
    assert len(got) == 901
    assert sum((got[i]["p_toxic"] >= 0.5) == bool(t) for i, _, t, _ in data[600:]) >= 295
    assert sum((got[i]["p_low_quality"] >= 0.5) == bool(p) for i, _, _, p in data[600:]) >= 290
    idle = toxicity.train(none, known.limit(0), toxicity.corpus_categories())
    assert idle.score(df).where("p_toxic > 0.01").count() == 0 and idle.score(none).count() == 0
    one = toxicity.train(df, known.where("toxic = 0 and quality = 1"), toxicity.corpus_categories())
    assert one.score(df).where("p_toxic > 0.01").count() == 0


# -- nearest neighbours

def test_forest_small_tables_are_exact(spark):
    r = np.random.default_rng(1)
    data = [(int(i), r.standard_normal(8).astype("float32").tolist()) for i in range(60)]
    data += [(100, data[0][1]), (101, data[0][1]), (200, None), (201, [0.0] * 8), (202, [float("nan")] + [1.0] * 7), (203, []), (204, [None] + [1.0] * 7), (None, data[3][1]), (0, data[0][1]), (300, [1.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    fit = {i: np.array(v, float) for i, v in data if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8}
    got = defaultdict(list)
    for q, k, v, s in rows(forest.nearest(df, "id % 10 = 0").orderBy("query_id", "rank"), "query_id", "rank", "vec_id", "score"):
        got[q].append((k, v, s))
    for q in [i for i in fit if i % 10 == 0]:
        score = {i: float((v * fit[q]).sum() / (np.sqrt((v * v).sum()) * np.sqrt((fit[q] ** 2).sum()))) for i, v in fit.items() if i != q}
        want = sorted(score, key=lambda i: (-score[i], i))[:5]
        assert [v for _, v, _ in got[q]] == want and [k for k, _, _ in got[q]] == [1, 2, 3, 4, 5]
        assert all(s == pytest.approx(score[v], abs=1e-15) for _, v, s in got[q])
    assert 200 not in got and 300 not in got
    assert forest.nearest(df.limit(0), "id % 10 = 0").count() == 0


def test_forest_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    ids, x = zip(*rows(df, "vec_id", "embedding"))
    x = np.array(x, float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    got = defaultdict(set)
    for q, v in rows(forest.nearest(df, "id % 50 = 0", wanted=700, block=600), "query_id", "vec_id"):
        got[q].add(v)
    hit = total = 0
    for n, q in enumerate(ids):
        if q % 50 == 0:
            s = unit @ unit[n]
            s[n] = -2
            best = {ids[i] for i in np.argsort(-s)[:5]}
            hit, total = hit + len(best & got[q]), total + 5
    assert hit / total >= 0.75  # a third of the rows looked at, blocks of a few hundred
    full = forest.nearest(df, "id % 50 = 0")
    hit = sum(v in {ids[i] for i in np.argsort(-(unit @ unit[ids.index(q)]))[1:6]} for q, v in rows(full, "query_id", "vec_id"))
    assert hit / total >= 0.9


def test_forest_with_many_blocks_and_a_hot_string(spark):
    """A third of the vectors have one string in every tree; blocks are far smaller than that, and than most stretches."""
    r = np.random.default_rng(12)
    hot = r.standard_normal(16)
    x = np.concatenate([hot + 1e-7 * r.standard_normal((500, 16)), r.standard_normal((1000, 16))])
    big = 1 << 61  # ids beyond the whole numbers that a double holds
    df = spark.createDataFrame([(big + i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for q, v, s in rows(forest.nearest(df, "id % 25 = 0", block=50).orderBy("query_id", "rank"), "query_id", "vec_id", "score"):
        got[q - big].append((v - big, s))
    asked = [i for i in range(len(x)) if (big + i) % 25 == 0]
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = 0
    for q in asked:
        far = unit @ unit[q]
        far[q] = -2
        assert len(got[q]) == 5
        hit += sum(s >= np.sort(far)[-5] - 1e-15 for _, s in got[q])
    assert set(got) == set(asked) and hit / (5 * len(asked)) >= 0.9


def test_digest_is_base32():
    import base64

    assert warc.digest(b"x") == base64.b32encode(hashlib.sha1(b"x").digest()).decode()
