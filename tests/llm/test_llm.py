"""Training-data operators against brute force, round trips and held-out accuracy; and odd inputs."""

from __future__ import annotations

import base64
import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from entityforge.llm import chat, components, jaccard, language_model, mixing, nearest, packing, quality_rules, registry, sharding, textstats, tokens, warc, weak_quality, wordhash
from entityforge.llm.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, rank int"

ODD = [
    (None, "a null id", "en", "s0", 9, "clash", 1),
    (2, None, "en", "s0", 0, "clash", 1),
    (3, "", "en", "s1", 0, None, None),
    (4, " \n\t ", None, None, None, None, None),
    (5, "same text here again and again", "en", "s1", 1, "x", 2),
    (5, "same text here again and again", "en", "s1", 1, "x", 2),
    (6, "same text here again and again", "en", None, 1, "x", 2),
    (7, "long " * 60_000 + "end", "en", "s2", 1, "x", 2),
    (8, "w" * 300_000, "en", "s2", 1, "x", 2),
    (9, "Üñí ünï 漢字 \u2003 wide\x0bvt \x00nul", "en", "s2", 1, "x", 2),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def table(spark, sf_dir, name):
    return rows_of(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def words(text):
    return WORD.findall(text or "")


# ---- sharding


def brute_shards(sized, shards):
    total, before, out = sum(s for _, s, _ in sized), 0, []
    slots = Counter()
    for doc, size, crc in sized:
        k = shards * (2 * before + size) // (2 * total)
        out.append((doc, size, crc, k, slots[k]))
        slots[k] += 1
        before += size
    return out


def test_sharding_like_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sized = sorted((d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in docs)
    got = rows_of(registry.op1_sharding(spark, sf_dir))
    assert {(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got} == set(brute_shards(sized, 8))
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_sharding_of_odd_rows(spark, odd):
    got = rows_of(sharding.assign_shards(odd, 3))
    assert len(got) == len(ODD)
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharding.assign_shards(odd.limit(0)).count() == 0


# ---- n-gram Jaccard join


def brute_components(docs):
    sets, unique = {}, defaultdict(list)
    for i, text in docs:
        w = [x.encode().lower() for x in words(text)]
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        if w:
            unique[sets[i]].append(i)
    keys, parent, index = list(unique), {}, defaultdict(list)

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, s in enumerate(keys):
        shared = Counter()
        for t in s:
            shared.update(index[t])
            index[t].append(k)
        for j, overlap in shared.items():
            if 100 * overlap >= 80 * (len(s) + len(keys[j]) - overlap):
                parent[find(k)] = find(j)
    least = defaultdict(list)
    for k, s in enumerate(keys):
        least[find(k)] += unique[s]
    out = {i: (len(s), i) for i, s in sets.items()}
    for k, s in enumerate(keys):
        for i in unique[s]:
            out[i] = (len(s), min(least[find(k)]))
    return out


def near_copies(seed, base_words, copies, edits):
    rng = random.Random(seed)
    base = [f"b{seed}w{i}" for i in range(base_words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(50)}"
        yield " ".join(text)


@pytest.mark.parametrize(
    ("seed", "widths", "list_classes", "frequent", "hot", "task"),
    [(1, (0, 8, 16), 2048, 16, 10**9, 1024), (2, (), 2048, 2, 10**9, 3), (3, (), 2, 2, 4, 2), (4, (0,), 4, 1000, 10**9, 1024)],
)
def test_jaccard_like_brute_force(spark, monkeypatch, seed, widths, list_classes, frequent, hot, task):
    monkeypatch.setattr(jaccard, "HOT_TOKEN", hot)
    monkeypatch.setattr(jaccard, "TASK_ENTRIES", task)
    monkeypatch.setattr(jaccard, "TASK_PAIRS", task)
    monkeypatch.setattr(jaccard, "WIDTHS", widths)
    monkeypatch.setattr(jaccard, "LIST_CLASSES", list_classes)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    texts = [*near_copies(seed, 60, 40, 6), *near_copies(seed + 100, 30, 30, 2), *near_copies(seed + 200, 7, 12, 1), "a b", "A b", "a b c", "", None, " "]
    texts += [t.upper() for t in texts[:5] if t] + [f"{t} tail {i}" for i, t in enumerate(texts[40:50])]
    docs = list(enumerate(texts))
    random.Random(seed).shuffle(docs)
    found = rows_of(jaccard.similar_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(docs)


def components_of_rows(rows):
    """(id, n_shingles, component_id) of each row, by brute force over rows; ids may repeat or be null, and null is the smallest."""
    found, ids = brute_components([(i, text) for i, (_, text) in enumerate(rows)]), defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[found[i][1]].append(doc)
    least = {c: None if None in v else min(v) for c, v in ids.items()}
    return [(doc, found[i][0], least[found[i][1]]) for i, (doc, _) in enumerate(rows)]


@pytest.mark.parametrize("shared", [7, None])
def test_jaccard_of_texts_under_one_id(spark, shared):
    """A~A' form a class by their least hash; B~B' have none in common, and B shares the id of A'."""
    shingles = jaccard.Shingles()

    def two(tag, same):
        """A text and a near copy, with one least hash or two."""
        for k in range(1000):
            text = [f"{tag}{k}w{i}" for i in range(60)]
            for at in range(60):
                copy = [*text[:at], "changed", *text[at + 1 :]]
                a, b = shingles.all([" ".join(text), " ".join(copy)])
                if (a[0] == b[0]) == same and (not same or jaccard.print_of(a) < jaccard.print_of(b)):
                    return " ".join(text), " ".join(copy)

    (a, a_copy), (b, b_copy) = two("a", True), two("b", False)
    rows = [(shared, a_copy), (shared, b), (1, a), (2, b_copy)]
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(1))
    assert Counter(tuple(r) for r in got.collect()) == Counter(components_of_rows(rows))


def test_sets_that_share_a_fingerprint_stay_apart(spark, monkeypatch):
    """With fingerprints of a few bits, the second one tells sets apart."""
    texts = [*near_copies(5, 40, 12, 3), *near_copies(6, 40, 12, 3), *(f"one two three four five {i}" for i in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scratch = Scratch(spark, "clashes")
    scanned = jaccard.scan(docs.select(F.col("doc_id").alias("doc"), F.col("doc_id").alias("key"), "text")).filter("kind = 0").withColumn("print", F.col("print") % 8)
    monkeypatch.setattr(jaccard, "scan", lambda base: scanned)
    _, rows, _, clashing = jaccard._scanned(scratch, docs, "doc_id", "text")
    got = [(r["set"], r["doc"]) for r in rows.collect()]
    sets = [frozenset(jaccard.Shingles().all([t]).__next__().tolist()) for t in texts]
    assert len(clashing) > 4 and len({s for s, _ in got}) == len(set(sets))


def test_block_pairs_like_brute_force():
    """Blocks skip nothing that may link."""
    rng = np.random.default_rng(4)
    n = 700
    a = {"token": np.sort(rng.integers(0, 5, n)), "n_min": rng.integers(1, 200, n)}
    order = np.lexsort((a["n_min"], a["token"]))
    a = {k: v[order] for k, v in a.items()}
    a |= {"n_max": a["n_min"] + rng.integers(0, 20, n), "left": rng.integers(1, 200, n), "root": rng.integers(0, 6, n), "class": rng.integers(0, 10**6, n)}
    i, j = np.triu_indices(n, 1)
    same = a["token"][i] == a["token"][j]
    i, j = i[same], j[same]
    ok = jaccard._may_link(a, i, j)
    found = [(x, y) for p, q in jaccard._block_pairs(a, jaccard._starts(a, "token")) for x, y in zip(p.tolist(), q.tolist())]
    assert sorted(found) == sorted(zip(i[ok].tolist(), j[ok].tolist()))


@pytest.mark.parametrize("ids", [lambda i: i % 5, lambda i: None if i % 3 else i])
def test_jaccard_of_repeated_and_null_ids(spark, ids):
    texts = [t for seed in range(12) for t in near_copies(seed, 60, 10, 3)] + ["", None]
    rows = [(ids(i), text) for i, text in enumerate(texts)]
    rows += rows[:20] * 3
    random.Random(1).shuffle(rows)
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == Counter(components_of_rows(rows))


@pytest.mark.parametrize("list_classes", [2048, 2])
def test_link_counts_like_brute_force(spark, monkeypatch, list_classes):
    monkeypatch.setattr(jaccard, "LIST_CLASSES", list_classes)
    texts = [t for seed in range(6) for t in near_copies(seed, 60, 12, 5)] + ["a b", "A b", "", None]
    rows = [(None if i % 4 == 0 else i % 9, t) for i, t in enumerate(texts)] * 2
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := words((t or "").lower())) else set() for _, t in rows]
    truth = [
        (doc, sum(j != i and 100 * len(a & b) >= 80 * len(a | b) and bool(a) for j, b in enumerate(sets))) for i, ((doc, _), a) in enumerate(zip(rows, sets))
    ]
    got = jaccard.link_counts(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == Counter(truth)


def test_link_counts_compare_only_pairs_that_bounds_leave_open(spark, monkeypatch):
    """200 near copies of one text, 100 more of a text near it: links as by brute force, under a third of all pairs compared."""
    rng, n = random.Random(8), 300
    base = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(n):
        text = list(base if i < 200 else [f"v{w}" if 40 <= k < 65 else w for k, w in enumerate(base)])
        for _ in range(rng.choice((0, 1, 1, 2, 9) if i < 200 else (1, 2))):
            text[rng.randrange(400)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(text))
    sets = [{" ".join(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    at = {t: i for i, t in enumerate(sorted(set().union(*sets)))}
    has = np.zeros((n, len(at)))
    for row, tokens in zip(has, sets):
        row[[at[t] for t in tokens]] = 1
    both, size = has @ has.T, has.sum(1)
    truth = ((100 * both >= 80 * (size[:, None] + size - both)).sum(1) - 1).tolist()
    compared = {}
    real = jaccard._Sets.overlaps

    def overlaps(self, pairs, name):
        found = real(self, pairs, name)
        compared[name] = found.count()
        return found

    monkeypatch.setattr(jaccard._Sets, "overlaps", overlaps)
    got = jaccard.link_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [r["n_links"] for r in got.orderBy("doc_id").collect()] == truth
    assert 0 < compared["met"] < n * (n - 1) / 2 / 3


def test_jaccard_finds_links_of_members_alone(spark):
    """Leaders that do not link, with members that do."""
    base = [f"w{i}" for i in range(204)]

    def changed(places, tag):
        out = list(base)
        for p in places:
            out[p] = f"{tag}{p}"
        return " ".join(out)

    docs = [(i, changed(range(3, 3 + 5 * k, 5), "a" if i % 2 else "b")) for i, k in enumerate([0, 1, 2, 3, 3, 4, 4, 5, 5, 6, 7])]
    found = rows_of(jaccard.similar_components(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(docs)


def test_member_links_of_classes_apart(spark):
    """The step on its own: leaders 0..79 and 20..99 share 60 of 100; a member between them links both classes."""
    ranges = {1: range(0, 80), 2: range(20, 100), 3: range(8, 88), 4: range(16, 96)}
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(r[0], r[-1] + 5))) for k, r in ranges.items()], "doc_id long, text string")
    scratch = Scratch(spark, "t")
    base, rows, _, clashing = jaccard._scanned(scratch, docs, "doc_id", "text")
    of = {r["doc"]: r["set"] for r in rows.collect()}
    assert {r["doc"]: r["n"] for r in rows.collect()} == dict.fromkeys(ranges, 80)
    sets = scratch.write(rows.groupBy("set", "n", "least").agg(F.min("key").alias("key")), "sets")
    x, y = sorted((of[1], of[2]))
    leaders = spark.createDataFrame([(x, y, 80, 80, 60)], "x long, y long, nx int, ny int, overlap int")
    members = spark.createDataFrame([(of[3], of[1], 80, 72), (of[4], of[2], 80, 76)], "set long, class long, n int, overlap int")
    known = jaccard._Sets(scratch, base, sets, clashing)
    links = jaccard._member_links(scratch, known, leaders, members, spark.createDataFrame([], "node long, root long"))
    assert {frozenset((r["u"], r["v"])) for r in links.collect()} == {frozenset((x, y))}
    connected = spark.createDataFrame([(x, x), (y, x)], "node long, root long")
    assert jaccard._member_links(Scratch(spark, "t"), known, leaders, members, connected) is None


def test_jaccard_of_odd_rows(spark, odd):
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows_of(jaccard.similar_components(odd))))
    assert len(got) == len(ODD) and got[0] == (False, 0, 1, None)
    by = {(x, n, c) for _, x, n, c in got}
    assert {(2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 2, 5), (6, 2, 5), (8, 1, 8), (9, 3, 9)} <= by
    assert jaccard.similar_components(odd.limit(0)).count() == 0


@pytest.mark.parametrize("most", [0, 1 << 30])
def test_components(spark, monkeypatch, most):
    monkeypatch.setattr(components, "ONE_TASK_EDGES", most)
    rng = random.Random(3)
    ids = [rng.getrandbits(62) for _ in range(200)]
    edges = [(ids[i], ids[i + 1]) for i in range(99)] + [(ids[150], ids[i]) for i in range(151, 199)] + [(ids[0], ids[0])]
    roots = {r["node"]: r["root"] for r in components.connected_components(Scratch(spark, "t"), spark.createDataFrame(edges, "u long, v long"), "c").collect()}
    assert len({roots[i] for i in ids[:100]}) == 1 and len({roots[i] for i in ids[150:199]}) == 1 and roots[ids[0]] != roots[ids[150]]


def test_word_hashes_tell_words(spark):
    texts = ["a b\tc", "", None, "B  b ", "x" * 700_000 + " y", "é \x0b é\x0c"]
    got = [h.tolist() for h in wordhash.WordHasher().all(texts)]
    flat = {}
    for text, hashes in zip(texts, got):
        expected = [w.encode().lower() for w in WORD.findall(text or "")]
        assert len(expected) == len(hashes)
        for w, h in zip(expected, hashes):
            assert flat.setdefault(w, h) == h
    assert len(set(flat.values())) == len(flat)


# ---- packing


def exact_bins(sizes, capacity):
    """Fewest bins, by trying all."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            k = rooms.index(room)
            place(i + 1, [*rooms[:k], room - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def test_dominance_fixes_only_what_some_optimum_has():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([10, 17, 30])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        counts = dict(Counter(sizes))
        fixed, rest = packing.dominance_reduction(dict(counts), capacity)
        used = Counter(s for p, n in fixed for s in p for _ in range(n))
        assert used + Counter(rest) == Counter(counts)
        left = [s for s, n in rest.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + exact_bins(left, capacity) == exact_bins(sizes, capacity)
        assert all(sum(p) <= capacity for p, _ in packing.plan(dict(counts), capacity))


def brute_ids(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(registry.tokenizer_path())
    return [[*model.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def check_packed(rows, expected):
    """Pieces are those of the documents, and sequences are gapless."""
    pieces = Counter()
    for doc, ids in expected:
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            pieces[doc, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces
    ends = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert all(n <= 2048 for n in ends.values())
    return len(ends), sum(ends.values())


def test_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    n, total = check_packed(rows_of(registry.op3_packing(spark, sf_dir)), list(zip([d["doc_id"] for d in docs], brute_ids([d["text"] for d in docs]))))
    assert n <= math.ceil(total / 2048 * 1.02) + 1


def test_packing_of_odd_rows(spark, odd):
    check_packed(rows_of(packing.pack(odd, registry.tokenizer_path())), list(zip([r[0] for r in ODD], brute_ids([r[1] for r in ODD]))))
    assert packing.pack(odd.limit(0), registry.tokenizer_path()).count() == 0


def test_word_cache_gives_the_tokenizers_ids(monkeypatch):
    texts = ["", "ǰ J̌ H̱at <|ENDOFTEXT|>", "x" * 700 + " y, " + "Q" * 300 + ",", "  a  b c\x1cd Don't \u0308x <|endoftext|>y ΑΣ Σ\r\n\tfoo, bar.  ", "a\x01b \x01 , . ,, x., İstanbul ½ 12á é \u3000z", "New, new, NEW. new"] * 2
    model = tokens.WordTokenizer(registry.tokenizer_path())
    monkeypatch.setattr(tokens, "CACHE_WORDS", 5)
    monkeypatch.setattr(tokens, "PART_WORDS", 3)
    for block in (1 << 18, 40, 7):
        monkeypatch.setattr(tokens, "BLOCK", block)
        monkeypatch.setattr(wordhash, "BLOCK", block)
        assert [x.tolist() + [0] for x in model.encode_all(texts)] == brute_ids(texts)


# ---- chat


def test_chat_round_trip(spark, sf_dir):
    hard = "\\### Assistant: </turn> ok"
    turns = [(r["conv_id"], r["turn"], r["role"], r["text"] or "") for r in table(spark, sf_dir, "conversations")] + [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    expected = {}
    for conv in {t[0] for t in turns}:
        own = sorted(t for t in turns if t[0] == conv)
        said = "".join(t[3] for t in own if t[2] == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in own).encode()).hexdigest()
        expected[conv] = (len(own), digest, len(said), hashlib.sha256(said.encode()).hexdigest())
    got = rows_of(registry.op4_chat(spark, sf_dir))
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == expected


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}], "id": 1},
        {"prompt": "a", "response": "b", "system": "s"}, {"instruction": "a", "input": "", "output": "b"}, {"question": "a", "answer": "b"}, {"prompt": {"text": "a"}, "response": {"text": "b"}},
        {"messages": []}, {"unknown": 1},
    ]
    rows = [(i, 0, json.dumps(r)) for i, r in enumerate(records)] + [(90, 0, None), (91, 0, "no json"), (92, 0, "[1]")]
    found = defaultdict(list)
    layouts = {}
    for r in sorted(rows_of(chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, record string"))), key=lambda r: (r["conv_id"], r["step"])):
        found[r["conv_id"]].append((r["role"], r["text"]))
        layouts[r["conv_id"]] = r["layout"]
    plain = [("user", "a"), ("assistant", "b")]
    assert found[0] == [("user", "a"), ("assistant", "")] and found[1] == found[3] == found[4] == found[5] == plain and found[2] == [("system", "s"), *plain]
    assert 6 not in found and layouts[7] is layouts[90] is layouts[91] is layouts[92] is None and found[91] == [(None, "no json")]


@pytest.mark.parametrize("text", ["", "\\", "\\\\", "### ", "#### x", "</turn>", "<\\/turn>", "a\n</turn>\n### user:\n", "\\#\\#"])
def test_escape_is_reversible(spark, text):
    out = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t"))).first()[0]
    assert chat.OPEN not in out and chat.CLOSE not in out and chat.unescape(out) == text


def test_chat_of_odd_rows(spark):
    turns = [(1, None, 0, None, None, "x"), (1, 0, 0, "user", "a", "x"), (1, 0, 0, "user", "a", "x"), (None, 0, 0, "a:\n%0A", "b", "x")]
    got = {r["conv_id"]: r for r in rows_of(chat.read_back(chat.format_turns(spark.createDataFrame(turns, chat.TURNS))))}
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == hashlib.sha256(b"\n\nuser\na\nuser\na\n").hexdigest()
    assert got[None]["turns_sha256"] == hashlib.sha256(b"a:\n%0A\nb\n").hexdigest() and got[1]["loss_chars"] == 0


# ---- quality


def brute_base(text):
    w = words(text)
    windows = list(zip(w, w[1:], w[2:]))
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_quality_rules(spark, sf_dir):
    texts = {d["doc_id"]: d["text"] for d in table(spark, sf_dir, "documents")}
    got = rows_of(registry.op7_rules(spark, sf_dir))
    for r in got:
        assert tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute_base(texts[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])
    labels = {x["doc_id"]: x["quality"] for x in table(spark, sf_dir, "labels")}
    clean = [r for r in got if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in clean) >= 0.97 * len(clean)


def test_rules_generalise_to_labels_that_the_fit_does_not_see(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumn("test", F.pmod(F.xxhash64(F.lit(99), "doc_id"), F.lit(3)) == 0)
    model = quality_rules.fit_rules(docs, labels.filter("not test"))
    judged = quality_rules.judge_texts(docs, model).select("doc_id", "rules.*").join(labels.filter("test"), "doc_id").collect()
    right = sum((r["probability"] >= 0.5) == (r["quality"] == 1) for r in judged)
    assert right >= 0.93 * len(judged)


def test_weak_labels_without_any_label(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = weak_quality.classify_texts(docs, weak_quality.fit_weak(docs)[0]).select("doc_id", "quality.kept").join(labels, "doc_id").collect()
    bad = [r for r in judged if r["quality"] == 0]
    good = [r for r in judged if r["quality"] == 1]
    assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad) and sum(r["kept"] for r in good) >= 0.97 * len(good)


def test_em_finds_how_accurate_labellers_are():
    rng = random.Random(5)
    right = (0.95, 0.9, 0.8, 0.6)
    patterns, good = Counter(), Counter()
    for _ in range(20_000):
        y = rng.random() < 0.8
        p = "".join("-" if rng.random() < 0.1 else ("g" if (rng.random() < a) == y else "b") for a in right)
        patterns[p] += 1
        good[p] += y
    posterior, tables = weak_quality.estimate(patterns)
    assert all(abs(posterior[p] - good[p] / n) < 0.1 for p, n in patterns.items() if n > 300)
    assert all(abs(tables[j, 0, 0] / (tables[j, 0, 0] + tables[j, 0, 1]) - a) < 0.05 for j, a in enumerate(right))
    assert weak_quality.estimate({}) [0] == {}


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_rules.fit_rules(odd, labels)
    judged = quality_rules.judge_texts(odd, model)
    assert judged.count() == len(ODD) and judged.columns == [*odd.columns, "rules"]
    assert [r["rules"]["n_words"] for r in judged.filter("doc_id = 2").collect()] == [0]
    assert weak_quality.classify_texts(odd, weak_quality.fit_weak(odd)[0]).count() == len(ODD)
    nothing = odd.limit(0)
    assert quality_rules.judge_texts(nothing, quality_rules.fit_rules(nothing, labels.limit(0))).count() == 0
    assert weak_quality.classify_texts(nothing, weak_quality.fit_weak(nothing)[0]).count() == 0


def test_repeated_words():
    rng = random.Random(2)
    for _ in range(200):
        w = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        assert textstats.repeated_words(textstats.WordNumbers().of(w)) == brute_base(" ".join(w))[4]


# ---- language model


def brute_model(docs):
    """Scores by dictionaries: the same mixture, with weights from the same cells."""
    toks = [(i, [x.encode().lower() for x in words(t)] + [1]) for i, t in docs]
    fold = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 5
    uni, bi, ctx = Counter(), Counter(), Counter()
    for i, t in toks:
        if fold(i) != 1:
            uni.update(t)
            pairs = list(zip([0, *t], t))
            bi.update(pairs)
            ctx.update(p[0] for p in pairs)
    n, v = sum(uni.values()), len(uni)
    cells = Counter()
    for i, t in toks:
        if fold(i) == 2:
            own, own2, own_c = Counter(t), Counter(zip([0, *t], t)), Counter([0, *t[:-1]])
            for a, b in zip([0, *t], t):
                c = ctx[a] - own_c[a]
                one = (uni[b] - own[b]) / (n - len(t)) if n > len(t) else 0
                two = (bi[a, b] - own2[a, b]) / c if c else 0
                q = [round(math.log2(x) * language_model.STEPS) + language_model.LOG_ZERO if x > 0 else 0 for x in (one, two)]
                cells[int(language_model.context_bucket(np.array([c]))[0]) << 40 | q[0] << 20 | q[1]] += 1
    weights = language_model.learn_weights(np.array(sorted(cells), dtype=np.int64), np.array([cells[k] for k in sorted(cells)], dtype=float), v)
    out = []
    for i, t in toks:
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        score = 0.0
        for a, b in zip([0, *t], t):
            w = weights[int(language_model.context_bucket(np.array([ctx[a]]))[0])]
            score += math.log10(w[0] / (v + 1) + w[1] * (uni[b] / n if n else 0) + w[2] * (bi[a, b] / ctx[a] if ctx[a] else 0))
        out.append((i is not None, i or 0, fold(i) == 1, len(t), sum(uni[w] > 0 for w in t), n, base, score))
    return pytest.approx(np.array(sorted(out), dtype=float), rel=1e-9)


def scored(df):
    keys = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    return np.array(sorted((r["doc_id"] is not None, r["doc_id"] or 0, *(r[k] for k in keys)) for r in rows_of(df)), dtype=float)


def test_language_model_like_brute_force(spark, sf_dir, monkeypatch):
    docs = [(d["doc_id"], d["text"]) for d in table(spark, sf_dir, "documents")]
    assert scored(registry.op6_language_model(spark, sf_dir)) == brute_model(docs)
    monkeypatch.setattr(language_model, "BUCKET_TOKENS", 500)
    got = registry.op6_language_model(spark, sf_dir)
    assert scored(got) == brute_model(docs)
    held = [r for r in got.collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_of_odd_rows(spark, odd):
    docs = [(r[0], r[1]) for r in ODD]
    assert scored(language_model.score_texts(odd)) == brute_model(docs)
    assert language_model.score_texts(odd.limit(0)).count() == 0
    only_test = spark.createDataFrame([(i, "a b") for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert {r["base_score"] for r in rows_of(language_model.score_texts(only_test))} == {0.0}


def test_language_model_in_two_levels(spark, sf_dir, monkeypatch):
    """Groups of chunks that ask together get the same counts."""
    docs = [(d["doc_id"], d["text"]) for d in table(spark, sf_dir, "documents")]
    for k, v in {"TWO_LEVELS": 1, "BUCKET_TOKENS": 2000, "CHUNK_TOKENS": 4000, "CHUNK_KINDS": 1000, "GROUP_KINDS": 3000}.items():
        monkeypatch.setattr(language_model, k, v)
    levels = language_model.Levels.of(30, 60)
    assert levels.groups > 1 and levels.fine > 1 and levels.words + levels.pairs > 2
    assert scored(registry.op6_language_model(spark, sf_dir)) == brute_model(docs)


def test_packed_keys():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        keys = np.unique(np.concatenate([rng.integers(0, 1 << k, n, dtype=np.uint64) for k in (3, 20, 58)] + [rng.integers(0, (1 << 64) - 1, n, dtype=np.uint64)]))
        assert (language_model._unpacked(language_model._packed(keys)) == keys).all()
        assert (language_model._large(language_model._small(keys.astype(np.uint32))) == keys.astype(np.uint32)).all()
    assert len(language_model._large(language_model._small(np.zeros(0, np.uint32)))) == 0


# ---- mixing


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Sharing again and again until no target is over its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_ = sum(w[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else w[s] * left / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        full |= over


def test_targets(spark):
    rng = random.Random(4)
    for sizes in ({"a": 10, "b": 1000, None: 5, "c": 0}, {"x": 7}, {f"s{i:02}": rng.choice([0, 1, 50, 9999]) for i in range(20)}, {"z": 0}):
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes), rel=1e-9, abs=1e-9)


def test_mixing(spark, sf_dir):
    docs = {d["doc_id"]: d for d in table(spark, sf_dir, "documents")}
    got = rows_of(registry.op8_mixing(spark, sf_dir))
    sizes = Counter()
    for d in docs.values():
        sizes[d["source"]] += len(words(d["text"]))
    target, taken, largest = brute_targets(sizes), Counter(), Counter()
    assert len(got) == len(docs)
    for r in got:
        source, n = docs[r["doc_id"]]["source"], len(words(docs[r["doc_id"]]["text"]))
        ratio = target[source] / sizes[source]
        assert (r["size"], r["source_size"]) == (n, sizes[source]) and r["target"] == pytest.approx(target[source])
        assert r["taken"] in (n * math.floor(ratio + 1e-9), n * math.ceil(ratio - 1e-9)) and r["taken"] <= 3 * n
        taken[source] += r["taken"]
        largest[source] = max(largest[source], n)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    again = rows_of(mixing.mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(7)))
    assert {(r["doc_id"], r["size"] * r["copies"]) for r in again} == {(r["doc_id"], r["taken"]) for r in got}


def test_mixing_is_fair(spark):
    """Over seeds, a row's copies average to its source's ratio."""
    rows = [(i, "w " * (1 + i % 7), "a" if i < 40 else "b") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    mean, seeds = Counter(), 12
    for seed in range(seeds):
        found = rows_of(mixing.mix_sources(docs, (1, 1), 3, seed=seed * 10))
        ratio = {r["source"]: r["target"] / r["source_size"] for r in found}
        for r in found:
            mean[r["source"]] += r["copies"] / seeds
    assert abs(mean["a"] / 40 - ratio["a"]) < 0.06 and abs(mean["b"] / 20 - ratio["b"]) < 0.08


def test_mixing_of_odd_rows(spark, odd):
    mixed = mixing.mix_sources(odd)
    assert mixed.count() == len(ODD) and {r["source"] for r in mixed.collect()} == {"s0", "s1", "s2", None}
    again = mixing.repeat_rows(odd, mixed)
    assert again.columns == odd.columns and again.count() == sum(r["copies"] for r in mixed.collect())
    assert mixing.mix_sources(odd.limit(0)).count() == 0


# ---- WARC


def test_warc(spark):
    pages = [(i, f"https://e.org/{i}", f"<p>{i % 7}</p>\r\n\r\nWARC/1.1\r\n" if i % 3 else None) for i in range(60)]
    pages += [(100, "https://e.org/a b\r\nX: y", "x" * 300_000), (101, None, "é"), (102, "", "é"), (102, "", "é"), (None, "u", "é")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    scratch = Scratch(spark, "warc_test")
    warc.write_archives(df.repartition(3), scratch.path("a"), 0)
    captures = rows_of(warc.assemble(warc.read_archives(spark, scratch.path("a"))))
    assert len(captures) == len(pages) and all(c["request"]["type"] == "request" and c["main"]["target_uri"] == c["request"]["target_uri"] for c in captures)
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    best = {}
    for i, _, h in pages:
        best[digest(h)] = max(best.get(digest(h), -1), -1 if i is None else i)
    got = Counter((c["metadata"]["page_id"], c["main"]["payload_digest"], c["main"]["payload_bytes"], c["main"]["type"]) for c in captures)
    want = Counter((i, digest(h), len((h or "").encode()), "response" if i == best[digest(h)] else "revisit") for i, _, h in pages)
    want[102, digest("é"), 2, "response"], want[102, digest("é"), 2, "revisit"] = 1, 1  # one of two rows that are alike
    assert got == want and len({c["capture_id"] for c in captures}) == len(pages)
    of = {c["main"]["record_id"]: c["metadata"]["page_id"] for c in captures if c["main"]["type"] == "response"}
    assert all(of[c["main"]["refers_to"]] == best[c["main"]["payload_digest"]] for c in captures if c["main"]["type"] == "revisit")
    assert {c["main"]["payload"].decode() for c in captures if c["main"]["type"] == "response"} == {h or "" for _, _, h in pages}
    warc.write_archives(df.limit(0), scratch.path("none"), 0)
    assert rows_of(warc.read_archives(spark, scratch.path("none"))) == []
    warc.write_archives(df, scratch.path("min"), 1 << 40)
    assert {r["type"] for r in rows_of(warc.read_archives(spark, scratch.path("min"), False).filter("type in ('response', 'revisit')"))} == {"response"}


@pytest.mark.parametrize("file_bytes", [1, 1 << 28])
def test_warc_of_payloads_full_of_line_ends(spark, monkeypatch, file_bytes):
    """Whatever of the separators a payload holds, its bytes come back; files are cut by bytes."""
    monkeypatch.setattr(warc, "FILE_BYTES", file_bytes)
    rng = random.Random(3)
    pages = [(i, f"u{i}", "".join(rng.choice(["\r", "\n", "\r\n", "a", "WARC/1.1\r\n", "\x00", "é"]) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    scratch = Scratch(spark, "warc_lines")
    warc.write_archives(df.repartition(2), scratch.path("a"), 1 << 40)
    captures = rows_of(warc.assemble(warc.read_archives(spark, scratch.path("a"))))
    assert {c["metadata"]["page_id"]: bytes(c["main"]["payload"]).decode() for c in captures} == {i: h for i, _, h in pages}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(scratch.path("a")).count()
    assert files == (120 if file_bytes == 1 else 2)


def test_warc_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    got = {r["page_id"]: r for r in rows_of(registry.op9_warc(spark, sf_dir))}
    assert len(got) == len(pages)
    for p in pages:
        raw = (p["html"] or "").encode()
        assert (got[p["page_id"]]["payload_bytes"], got[p["page_id"]]["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())


# ---- nearest neighbours


def brute_nearest(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q, v in queries:
        v = np.array(v, dtype=float)
        score = x @ v / (norm * np.sqrt(v @ v))
        out[q] = sorted((-s, i) for i, s in zip(ids.tolist(), score.tolist()) if i != q)[:k]
    return out


def test_recall(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings")]
    truth = brute_nearest(rows, [r for r in rows if r[0] % 50 == 0], 5)
    found = defaultdict(list)
    for r in sorted(rows_of(registry.op10_nearest(spark, sf_dir)), key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((-r["score"], r["vec_id"]))
    assert set(found) == set(truth) and all(len(v) == 5 and v == sorted(v) for v in found.values())
    hits = sum(len({i for _, i in found[q]} & {i for _, i in t}) for q, t in truth.items())
    assert hits >= 0.9 * 5 * len(truth)


def test_nearest_of_odd_rows(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(30)] + [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100, 160)]
    odd = [(50, None), (200, [0.0] * 4), (201, [1.0, None, 1.0, 1.0]), (202, [1.0, float("nan"), 1.0, 1.0]), (203, [float("inf")] * 4), (None, [1.0] * 4), (250, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = defaultdict(list)
    for r in rows_of(nearest.search(df, F.col("vec_id") % 50 == 0, 5)):
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    truth = brute_nearest(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {q: [i for _, i in t] for q, t in truth.items()}
    assert nearest.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# ---- pipeline


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("_verdict", F.lit(1))
    scratch, before = Scratch(spark, "stages"), None
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch.write(stage(spark, docs, sf_dir), f"s{i}")
        before, after = rows_of(docs), rows_of(out)
        if i < 4:
            assert out.columns == docs.columns
        if i in (0, 1):
            assert len(after) <= len(before) and {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
        if i == 0:
            assert all(not brute_base(r["text"])[5] for r in after)
        if i == 2:
            kept = {d for d, (_, c) in brute_components([(r["doc_id"], r["text"]) for r in before]).items() if d == c}
            assert sorted(r["doc_id"] for r in after) == sorted(kept)
        if i == 3:
            mixed = {r["doc_id"]: r["copies"] for r in rows_of(mixing.mix_sources(docs))}
            assert Counter(r["doc_id"] for r in after) == Counter({d: n for d, n in mixed.items() if n})
        if i == 4:
            check_packed(after, list(zip([r["doc_id"] for r in before], brute_ids([r["text"] for r in before]))))
        docs = out
    assert corpus_pipeline.run(spark, sf_dir).count() == len(after)


def test_near_copies_with_repeated_ids(spark, odd):
    kept = rows_of(corpus_pipeline.near_copies_stage(spark, odd, ""))
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 2, 3, 4, 5, 7, 8, 9]


def test_near_copies_decided_by_row(spark):
    """Near copies under one id and under null end with one row, an unrelated text under a lost row's id stays, and rows without words stay."""
    t, near, other, third, near_third = (" ".join(f"{tag}{i}" if i else first for i in range(60)) for tag, first in [("t", "t0"), ("t", "x"), ("u", "u0"), ("v", "v0"), ("v", "x")])
    null, near_null = (" ".join(f"n{i}" if i else first for i in range(60)) for first in ("n0", "x"))
    rows = [(1, t), (5, near), (5, other), (8, third), (8, near_third), (8, third), (None, null), (None, near_null), (9, null), (6, ""), (6, ""), (None, None), (None, None)]
    kept = [tuple(r) for r in corpus_pipeline.near_copies_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    of_eight, of_null = {(8, third), (8, near_third)}, {(None, null), (None, near_null)}
    assert len([r for r in kept if r in of_eight]) == len([r for r in kept if r in of_null]) == 1
    assert Counter(r for r in kept if r not in of_eight | of_null) == Counter([(1, t), (5, other), (6, ""), (6, ""), (None, None), (None, None)])
