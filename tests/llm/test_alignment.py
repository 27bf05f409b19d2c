"""Aligned tokens against a plain merge of one document at a time."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from test_contracts import DOCS
from conftest import SMALL

from tradeledger.llm import alignment
from tradeledger.llm.batches import prepare
from tradeledger.llm.queries import QUERIES

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokens_of():
    """Plain tokenizers: (ids of A, ids of B, bytes of A tokens, bytes of B tokens) for a text."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(c): c for c in plain}
    chars |= {chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in plain)}

    def encode(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            byte = len(piece) == 6 and piece.startswith("<0x") and b.is_byte(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        return ids_a, ids_b, bytes_a, bytes_b

    return encode


def plain(docs):
    encode, links, groups = tokens_of(), [], []
    for _, text in docs:
        links.append([])
        groups.append([])
        if not text:
            continue
        ids_a, ids_b, bytes_a, bytes_b = encode(text)
        if b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
            continue
        i = j = begin_a = begin_b = at_a = at_b = 0
        while i < len(ids_a):
            links[-1].append((ids_a[i], ids_b[j]))
            end_a, end_b = at_a + len(bytes_a[i]), at_b + len(bytes_b[j])
            if end_a <= end_b:
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups[-1].append((ids_a[begin_a:i], ids_b[begin_b:j]))
                begin_a, begin_b = i, j
    counts = Counter(p for x in links for p in set(x))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (doc, _), link, group in zip(docs, links, groups, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in group)
        out.append((
            doc, sum(len(a) for a, _ in group), sum(len(b) for _, b in group), len(group), len(link),
            sum(counts[p] == most[p[0]] for p in link), sum(counts[p] for p in link), brute.sha(text) if text else "",
        ))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(df.columns[0], *COLUMNS).collect()), key=str)


LONG = " ".join("".join(random.Random(i).choice("abcdefghé") for _ in range(i % 9 + 1)) for i in range(30_000))
CASES = [
    (1, "Hello, world!  two  spaces\n\nand\tlines ▁ no"), (2, "Hello, world!"), (3, None), (4, ""), (5, " "),
    (6, "<|endoftext|> and <s> </s> <unk> <0x41> are plain"), (7, "ÀÉ ß 'tis don't x́   ½ ＡＢ \U0001f600"),
    (8, LONG), (9, "a" * 5000), (10, "\r\n\x00\x01 \x7f"), (11, " leading and trailing "), (None, "Hello, world!"), (2, "Hello"),
    (12, "日本語の文"), (13, "word"),
]


def test_registered_query(spark):
    want = plain(DOCS)
    assert got(QUERIES["op13_align"](spark, SMALL)) == want
    assert any(r[1] for r in want) and len({r[6] for r in want}) > 100


@pytest.mark.parametrize(("parts", "chunk"), [(1, 3_000_000), (3, 40), (5, 1)])
def test_cases_in_any_chunks(spark, parts, chunk):
    prepare(spark)
    docs = spark.createDataFrame([(d, "x", t, "y") for d, t in CASES], "doc_id long, ID string, text string, held string")
    first, second = alignment.tokenizer_files()
    found = alignment.align_tokens(docs.repartition(parts), first, second, digest=True, chunk_pairs=chunk)
    assert got(found) == plain(CASES)
    # U+2581 is given back as a space, so that text has no tokens.
    assert [tuple(r) for r in found.where("doc_id = 1").drop("doc_id").collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_groups_as_lists(spark):
    prepare(spark)
    first, second = alignment.tokenizer_files()
    docs = spark.createDataFrame([("x", "Hello, world!"), ("y", None)], "name string, text string")
    rows = {r.name: r for r in alignment.align_tokens(docs, first, second, id_column="name").collect()}
    encode = tokens_of()
    a, b, *_ = encode("Hello, world!")
    assert sum((g.a for g in rows["x"].groups), []) == a and sum((g.b for g in rows["x"].groups), []) == b
    assert len(rows["x"].groups) == rows["x"].n_groups and rows["y"].groups == []
    assert alignment.align_tokens(docs.limit(0), first, second, id_column="name").collect() == []


@pytest.mark.parametrize(("lane", "seek"), [(1, 1), (2, 3), (5, 64), (1000, 1)])
def test_lanes_change_nothing(lane, seek):
    """Random cuts of random documents: links and cuts equal those of whole documents."""
    pick = np.random.default_rng(lane)
    ends, firsts = ([], []), ([0], [0])
    base = 0
    for size in (1, 7, 300, 0, 50):
        for side in (0, 1):
            if size:
                inner = np.flatnonzero(pick.random(size - 1) < 0.6) + 1
                ends[side].extend((base + np.append(inner, size)).tolist())
            firsts[side].append(len(ends[side]))
        base += size
    ends_a, ends_b = (np.array(x, np.int64) for x in ends)
    first_a, first_b = (np.array(x, np.int64) for x in firsts)
    whole = alignment.lockstep(ends_a, ends_b, *alignment.lanes_of(ends_a, ends_b, first_a, first_b, 10**6))
    lanes = alignment.lanes_of(ends_a, ends_b, first_a, first_b, lane, seek)
    cut = alignment.lockstep(ends_a, ends_b, *lanes)
    assert len(lanes[0]) > 4 or lane == 1000
    for i in (0, 2):
        assert sorted(zip(whole[i].tolist(), whole[i + 1].tolist())) == sorted(zip(cut[i].tolist(), cut[i + 1].tolist()))
    assert set(ends_a[whole[2]].tolist()) == set(ends_a.tolist()) & set(ends_b.tolist())


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    """Random mixtures of letters, marks, digits and every kind of blank; a memory of a few words."""
    monkeypatch.setattr(alignment, "CACHE_WORDS", 50)
    words, encode = alignment.WordIds(*alignment.tokenizer_files()), tokens_of()
    assert words.by_word
    pick = random.Random(4)
    parts = [
        "a", "word", "Ab", "7", "12", "'s", "'", "!", "é", "x́", "日", "\U0001f600", "<s>", "▁", "\x1c", "\x85", "\xa0",
        " ", "　", "​", "\n", "\t", "\r", "\x00", " ", " ", " ", " ", " ", " ", " ",
    ]
    texts = ["".join(pick.choices(parts, k=pick.randrange(1, 40))) for _ in range(3000)]
    for at in range(0, len(texts), 100):
        batch = texts[at : at + 100]
        for text, found in zip(batch, words.of(batch), strict=True):
            a, b, bytes_a, bytes_b = encode(text)
            lost = b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode()
            want = ([], []) if lost else (a, b)
            assert tuple(np.frombuffer(x, np.uint32).tolist() for x in found) == want, text


def counted(monkeypatch, words):
    """Texts that the two tokenizers get."""
    sent = ([], [])
    for tokenizer, seen in zip((words.one, words.two), sent):
        encode = tokenizer.encode
        monkeypatch.setattr(tokenizer, "encode", lambda x, f=encode, s=seen: (s.extend(x), f(x))[1])
    return sent


def test_new_words_are_encoded_in_runs(monkeypatch):
    """Runs with a word that is not given back, and blanks at the ends of texts, give each word its own ids."""
    words, encode = alignment.WordIds(*alignment.tokenizer_files()), tokens_of()
    sent = counted(monkeypatch, words)
    many = [f"w{i}x" for i in range(1000)]
    texts = [" ".join(many), "w1x ▁ w2x", None, "  w3x new\tw4x ", "", " ".join(many[::-1]), "x" * 40 + " w5x " + "x" * 40]
    found = words.of(texts)
    assert all(len(s) < 200 for s in sent)
    for text, got_ids in zip(texts, found, strict=True):
        want = encode(text)[:2] if text and "▁" not in text else ([], [])
        assert tuple(np.frombuffer(x, np.uint32).tolist() for x in got_ids) == tuple(want), text
    assert "x" * 40 not in words.numbers
    # A run that is not given back for another reason goes word by word.
    monkeypatch.setattr(words.two, "encode", lambda x, f=words.two.encode: [y if "bad" not in t else y[:-1] for t, y in zip(x, f(x))])
    assert [bool(a) for a, _ in words.of(["new1 new2", "new3 bad new4"])] == [True, False]
    assert words.of(["new3 new4"])[0][1] == np.array(encode("new3 new4")[1], np.uint32).tobytes()


def test_common_words_are_not_forgotten(monkeypatch):
    """Words of every batch are encoded once, however many words are met only once."""
    monkeypatch.setattr(alignment, "CACHE_WORDS", 300)
    words = alignment.WordIds(*alignment.tokenizer_files())
    sent = counted(monkeypatch, words)
    common = [f"every{i}" for i in range(40)]
    # Half of the common words stay away from every other batch.
    for n in range(60):
        words.of([" ".join(common[: 40 if n % 2 else 20] + [f"once{n}x{i}" for i in range(30)])])
        assert len(words.numbers) <= 370 and len(words.numbers) == len(words.known.lost) == len(words.used)
    for seen in sent:
        assert " ".join(seen).split().count("every30") == 1


def test_words_of_a_failed_batch_are_learned_anew(monkeypatch):
    words = alignment.WordIds(*alignment.tokenizer_files())
    words.of(["one two"])
    with monkeypatch.context() as broken, pytest.raises(MemoryError):
        broken.setattr(words.two, "encode", lambda x: (_ for _ in ()).throw(MemoryError()))
        words.of(["two three"])
    fresh = alignment.WordIds(*alignment.tokenizer_files())
    assert words.of(["three two one"]) == fresh.of(["three two one"])


def test_runs_whose_tokens_cross_words_are_encoded_by_word(monkeypatch):
    """A tokenizer that joins words of a run, although its tokens were taken not to."""
    words = alignment.WordIds(*alignment.tokenizer_files())
    words.one.tokens, words.sizes[0] = [b" a", b" b", b" a b"], np.array([2, 2, 4])
    monkeypatch.setattr(words.one, "encode", lambda x: [[{"a": 0, "b": 1, "a b": 2}[t]] for t in x])
    assert [np.frombuffer(x, np.uint32).tolist() for x, _ in words.of(["a b", "b a"])] == [[0, 1], [1, 0]]
