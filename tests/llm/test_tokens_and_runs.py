"""Token counts, alignment of tokenizers and periodic runs against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from math import floor

import numpy as np
import pytest

from emporium.llm import periodic_runs, queries, token_align, token_counts
from emporium.llm.common import read, shared_dir, tokenizer_path

SF = "/root/testdata/sf0.001"
A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SPACES = " \t\n\x0b\x0c\r"


def _odd(seed, n):
    r = random.Random(seed)
    bits = [" ", "  ", "\n", "\n ", " \n", "\t", "\x1c", "\xa0", " ", "a", "Bc", "don't", "'s", "123", "é", "ñu", "語", "\U0001F600", "...",
            "<|endoftext|>", "<s>", "<0x41>", "\x00", "İ", "١٢", "_", "the", " quick", "​"]
    return "".join(r.choice(bits) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    prose = " ".join(f"word{i % 37} and then, {i}" for i in range(200))
    out = [(0, prose), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose), (5, prose), (None, prose), (None, None),
           (6, "has ▁ mark"), (7, "  lead and trail  "), (8, "<|endoftext|> x <|endoftext|>"), (9, "x" * 30000),
           (10, "a b c " * 4000), (11, prose + "▁"), (30, "b" + " " * 5000)]
    return out + [(100 + k, _odd(k, 5 + 3 * k)) for k in range(40)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    schema = "doc_id long, text string, digest string, n_tokens string, shard string, runs string, _h string"
    return spark.createDataFrame([(i, t, "d", "n", "s", "r", "h") for i, t in rows], schema).repartition(4)


def _same(got, want):
    order = lambda rows: sorted(rows, key=repr)
    assert order(got) == order(want)


# --- token counts ------------------------------------------------------------

def _tokenizer(special_as_text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = special_as_text
    return t


def test_token_counts(spark, docs, rows, tmp_path, monkeypatch):
    tok, cache = _tokenizer(False), str(tmp_path / "cache")
    want = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    _same([tuple(r) for r in token_counts.token_counts(docs, cache, A).collect()], want)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in rows})
    # The second run finds everything; new texts alone are encoded; another version starts anew.
    encode, seen = token_counts.encoded, []
    monkeypatch.setattr(token_counts, "encoded", lambda texts, path: (seen.append(texts.count()), encode(texts, path))[1])
    _same([tuple(r) for r in token_counts.token_counts(docs, cache, A).collect()], want)
    assert seen == []
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(900, "new text"), (901, "new text"), (902, "")], "a long, b string"))
    got = {r[0]: r[2] for r in token_counts.token_counts(more, cache, A).where("doc_id >= 900").collect()}
    assert got == {900: 2, 901: 2, 902: 0} and seen == [1]
    monkeypatch.setattr(token_counts, "tokenizer_file", lambda path, f=token_counts.tokenizer_file: (f(path)[0], "other"))
    assert token_counts.token_counts(docs, cache, A).count() == len(rows)
    assert {r[0] for r in spark.read.parquet(cache).groupBy("tokenizer").count().select("count").collect()} == {
        len({t or "" for _, t in rows}), len({t or "" for _, t in rows}) + 1}
    assert token_counts.token_counts(docs.limit(0), cache, A).count() == 0


def test_token_counts_twice_stored(spark, docs, tmp_path):
    """Entries appended by two jobs at a time count once."""
    cache = str(tmp_path / "cache")
    n = token_counts.token_counts(docs, cache, A).count()
    spark.read.parquet(cache).write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert token_counts.token_counts(docs, cache, A).count() == n == docs.count()


# --- alignment ---------------------------------------------------------------

def _plain_align(rows):
    """Whole texts, every pair of occurrences tested for overlap per group."""
    import sentencepiece
    tok, sp = _tokenizer(True), sentencepiece.SentencePieceProcessor(model_file=B)
    byte = token_align._byte_of_char()
    vocab = {i: t for t, i in tok.get_vocab(with_added_tokens=False).items()}
    aligned = []
    for i, t in rows:
        a, b = tok.encode(" " + (t or ""), add_special_tokens=False).ids, sp.encode(t or "")
        ta = [bytes(byte[c] for c in vocab[x]) for x in a]
        tb = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode() for x in b]
        want = (" " + (t or "")).encode()
        if not t or b"".join(ta) != want or b"".join(tb) != want:
            aligned.append((i, [], [], [], ""))
            continue
        ea, eb = np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
        links, groups, common, sa, sb, low = [], [], sorted(set(ea) & set(eb)), 0, 0, 0
        for c in common:
            na, nb = ea.index(c, sa) + 1, eb.index(c, sb) + 1
            for x in range(sa, na):
                for y in range(sb, nb):
                    if max(ea[x] - len(ta[x]), eb[y] - len(tb[y])) < min(ea[x], eb[y]):
                        links.append((a[x], b[y]))
            groups.append(",".join(map(str, a[sa:na])) + "|" + ",".join(map(str, b[sb:nb])))
            sa, sb = na, nb
        aligned.append((i, a, b, links, ";".join(groups)))
    count = Counter(p for _, _, _, links, _ in aligned for p in set(links))
    top = defaultdict(int)
    for (x, _), c in count.items():
        top[x] = max(top[x], c)
    return [(i, len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(count[p] == top[p[0]] for p in links),
             sum(count[p] for p in links), g) for i, a, b, links, g in aligned]


def test_alignment(docs, rows, monkeypatch):
    want = _plain_align(rows)
    assert sum(r[1] == 0 for r in want) > 4 and sum(r[4] for r in want) > 5000
    _same([tuple(r) for r in token_align.align(docs, A, B).collect()], want)
    _same([tuple(r) for r in token_align.align(docs, A, B, broadcast_pairs=0).collect()], want)
    assert token_align.align(docs.limit(0), A, B).count() == 0
    assert [tuple(r)[1:7] for r in token_align.align(docs.where("text is null"), A, B).collect()] == [(0,) * 6] * 2


def test_alignment_small_blocks_and_deep_tree(docs, rows, monkeypatch):
    """More blocks than one fan-in: the sums go up two levels and more."""
    monkeypatch.setattr(token_align, "FAN", 2)
    monkeypatch.setattr(token_align, "FLUSH", 50)
    monkeypatch.setattr(token_align, "BLOCK_CHARS", 100)
    _same([tuple(r) for r in token_align.align(docs.repartition(11), A, B).collect()], _plain_align(rows))


def test_perfect_hash():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        keys = np.unique(r.integers(0, 2 ** 47, n))
        sizes, words = token_align.perfect_hash(keys)
        assert sorted(token_align.slots(keys, sizes, words).tolist()) == list(range(len(keys)))
    shard = token_align.Shard(sizes, words, np.sort(keys)[::-1], keys, keys)
    with pytest.raises(ValueError):
        shard.look_up(np.array([2 ** 50]))


# --- periodic runs -----------------------------------------------------------

def _plain_runs(w):
    n, out = len(w), set()
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            s, size = i - q, j - i + q
            if size >= max(24, 3 * q) and not any(all(w[s + k] == w[s + k - x] for k in range(x, size)) for x in range(1, q)):
                out.add((s, size, q))
            i = j
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_runs_random():
    r, hits = random.Random(3), 0
    for _ in range(1500):
        n, letters = r.randint(0, 140), r.choice([1, 2, 2, 3, 5])
        w = [b"%d" % r.randrange(letters) for _ in range(n)]
        if n and r.random() < .7:
            a = r.randrange(n)
            p = 1 + (n - a) // (3 + r.randrange(8))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n and r.random() < .3:
            w[r.randrange(n)] = b"x"
        want = _plain_runs(w)
        assert periodic_runs.find_runs(w) == want
        assert sorted(periodic_runs.runs_of(w), key=lambda x: (x[0], x[2])) == want  # the automaton without pruning
        hits += len(want)
    assert hits > 500


def test_runs_of_long_texts():
    assert periodic_runs.find_runs([1] * 100_000) == [(0, 100_000, 1)]
    assert periodic_runs.find_runs([i if i < 1000 else 1000 + i % 30_000 for i in range(100_000)]) == [(1000, 99_000, 30_000)]
    assert periodic_runs.find_runs([i % 9999 for i in range(20_000)]) == []  # two periods only


def _digest(rows):
    """The registered columns, from the rule of the contract and brute force."""
    for i, t in rows:
        w = [x for x in "".join(" " if c in SPACES else c for c in t or "").split(" ") if x]
        n, h = len(w), None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + floor((n - a) / (3 + g % 8))
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = _plain_runs(w)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        gone = {k for s, size, q in runs for k in range(s + q, s + size)}
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        yield (i, len(runs), *best, None if not runs else 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % x for x in runs)),
               sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_runs_query(spark, monkeypatch):
    def text(k):
        r = random.Random(k)
        body = " ".join(r.choice("a b c d e f g".split()) for _ in range(r.randint(0, 120)))
        return body + r.choice([" ", "\n", "\t\r", "\x0b\x0c"]) + "tail words here " * r.randint(0, 15)
    own = [(k, text(k)) for k in range(150)] + [(None, "a b " * 30), (None, None), (7, None), (8, ""), (9, " \n"), (9, " \n"),
                                                 (200, "x\x1cy\xa0z " * 20)]
    schema = "doc_id long, text string, _w string, _n string, best string"
    docs = spark.createDataFrame([(i, t, "w", "n", "b") for i, t in own], schema).repartition(3)
    monkeypatch.setattr(queries, "read", lambda *a: docs)
    got = queries.op13_periodic_runs(spark, SF)
    want = list(_digest(own))
    _same([tuple(r) for r in got.collect()], want)
    assert sum(r[1] > 0 for r in want) > 30
    monkeypatch.setattr(queries, "read", lambda *a: docs.limit(0))
    assert queries.op13_periodic_runs(spark, SF).count() == 0


# --- given documents ---------------------------------------------------------

def test_given_documents(spark):
    own = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    tok = _tokenizer(False)
    got = [tuple(r) for r in queries.op12_token_counts(spark, SF).collect()]
    n = [len(e.ids) for e in tok.encode_batch([t or "" for _, t in own], add_special_tokens=False)]
    _same(got, [(i, len((t or "").encode()), k, k > 512) for (i, t), k in zip(own, n)])
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in _plain_align(own)]
    _same([tuple(r) for r in queries.op11_token_align(spark, SF).collect()], want)


def test_given_documents_runs(spark):
    own = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    short = [(i, t) for i, t in own if len(t or "") < 8000]
    got = [tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()]
    assert len(got) == len(own)
    keep = {i for i, _ in short}
    _same([r for r in got if r[0] in keep], list(_digest(short)))
    assert shared_dir(spark)
