"""Alignment, fill-in-the-middle and byte-pair operators against libraries and brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from textpulse.llm import alignment, byte_pairs, piece_table

SCHEMA = "doc_id long, text string, form string, pieces string, output string, d string, salt string, text_key string"
SIGNS = "ab  e.,'\"▁\n\t0x<>é日本😀　\x00s–\x1c\x85\xa0 rl've²½五Dž"


def texts():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeéüst") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(40)]
    noise = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(1, 40))) for _ in range(120)]
    odd = [None, "", " ", "  ", " \n\t ", "x", "x ", "<P>x", "a<S>b c", "<|endoftext|> </s> <0x41> <unk>", "▁q  ", "\x00y"]
    long = ["a" * 5_000, "ab " * 3_000, "日本 語 " * 400, "the'll " * 900 + "'" * 300, "\n \n" * 300 + "x"]
    copies = [prose[3]] * 30 + [prose[4] + " "] * 5
    return prose + noise + odd + long + copies


@pytest.fixture(scope="module")
def rows():
    out = [(i * 3 % 211, t, "f", "p", "o", "d", "s", "k") for i, t in enumerate(texts())]
    return [*out, out[5], out[5], (None, "no id " * 30, *"fpodsk"), (None, None, *"fpodsk")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def key(r):
    return tuple("\0" if v is None else str(v) for v in r)


def same(got, want):
    assert sorted(map(key, got)) == sorted(map(key, want))


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# Byte pairs.


@pytest.fixture(scope="module")
def tree():
    return byte_pairs.BytePairs(byte_pairs.default_ranks(), byte_pairs.default_pattern())


@pytest.fixture(scope="module")
def library(tree):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tree.ranks, special_tokens={})


def test_byte_pairs_equal_the_library(docs, rows, library):
    want = []
    for r in rows:
        ids = library.encode_ordinary(r[1] or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((r[0], len(ids), sha(raw), sha(library.decode_bytes(ids))))
    same(byte_pairs.digests(docs).collect(), want)


@pytest.mark.parametrize("leaf, match_leaf", [(1, 1), (3, 2), (7, 5), (64, 16)])
def test_any_tree_gives_the_ids_of_the_library(tree, library, leaf, match_leaf, monkeypatch):
    monkeypatch.setattr(byte_pairs, "TEXT_LEAF", leaf)
    monkeypatch.setattr(byte_pairs, "MATCH_LEAF", match_leaf)
    monkeypatch.setattr(tree, "known", byte_pairs._Matches(tree))
    rng = random.Random(leaf)
    for _ in range(1_500):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 25)))
        assert tree.encode(text) == library.encode_ordinary(text), text
    for text in ["a" * 777, "x." + "a" * 600, "'" * 90 + "re" * 50, " " * 300, "\n \n" * 90 + "x", "abcdefgh" * 60]:
        assert tree.encode(text) == library.encode_ordinary(text)


def test_joins_are_associative(tree):
    rng = random.Random(2)
    for _ in range(300):
        data = bytes(rng.choice(b"abcdeaaabb  \xc3\xa9") for _ in range(rng.randint(3, 40)))
        one, two = sorted(rng.sample(range(1, len(data)), 2))
        a, b, c = map(tree.merge, (data[:one], data[one:two], data[two:]))
        assert tree.join(tree.join(a, b), c) == tree.join(a, tree.join(b, c)) == tree.merge(data)


def test_cached_matches_give_way_to_new_ones(tree, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "CACHED_MATCHES", 20)
    monkeypatch.setattr(tree, "known", byte_pairs._Matches(tree))
    for n in range(60):
        text = f"word{n} and {n * 7} more{n // 2}"
        ids = tree.encode_all([text])[0]
        assert byte_pairs.unpacked(ids) == library.encode_ordinary(text)
        assert len(tree.known) <= 40


def test_byte_pair_round_trip_keeps_other_columns(docs, rows):
    got = byte_pairs.decoded(byte_pairs.encoded(docs, out="d"), ids="d", out="salt")
    assert got.columns == docs.columns
    same([(r.doc_id, bytes(r.salt).decode()) for r in got.collect()], [(r[0], r[1] or "") for r in rows])


def test_unreachable_entries_are_refused(tmp_path):
    import base64

    entries = [bytes([b]) for b in range(256)] + [b"abc"]
    ranks = tmp_path / "ranks"
    ranks.write_text("\n".join(f"{base64.b64encode(e).decode()} {i}" for i, e in enumerate(entries)))
    with pytest.raises(ValueError, match="no merges"):
        byte_pairs.BytePairs(str(ranks), r"\S+|\s+")


# Fill in the middle.


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:first]), "".join(units[first:second]), "".join(units[second:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def test_fim_report(docs, rows):
    want = []
    for r in rows:
        *head, output, text = plain_fim(r[0], r[1])
        want.append((r[0], *head, sha(output), sha(text)))
    got = piece_table.fim_report(docs)
    assert got.columns == "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256".split()
    same(got.collect(), want)
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_fim_outputs_and_restored_texts(docs, rows):
    got = piece_table.restored(piece_table.arranged(docs), out="d")
    want = [plain_fim(r[0], r[1]) for r in rows]
    same([(r.doc_id, r.form, r.output, r.d) for r in got.collect()], [(r[0], w[1], w[4], w[5]) for r, w in zip(rows, want)])
    assert {len(r.pieces) for r in got.collect()} == {1, 6}


def test_descriptors_are_cut_anywhere():
    text = "abc de"
    for one in range(7):
        pieces = piece_table.cut([piece_table.Piece(False, 0, 6)], one)
        for two in range(7):
            again = piece_table.cut(pieces, two)
            assert "".join(piece_table.stretches(text, again)) == text
    with pytest.raises(ValueError):
        piece_table.cut([piece_table.Piece(False, 0, 6)], 7)


# Alignment.


def plain_alignment(rows):
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in printable} | {
        b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in printable)
    }
    byte_of = {v: k for k, v in signs.items()}
    found, docs = [], Counter()
    for _, text in rows:
        spaced = (" " + (text or "")).encode()
        ids_a = a_model.encode(spaced.decode(), add_special_tokens=False).ids if text else []
        ids_b = b_model.encode(text) if text else []
        raw_a = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in ids_a]
        raw_b = []
        for i in ids_b:
            piece = b_model.id_to_piece(i)
            raw_b.append(bytes([int(piece[3:-1], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode())
        if b"".join(raw_a) != spaced or b"".join(raw_b) != spaced:
            found.append(None)
            continue
        spans = []
        for raw in (raw_a, raw_b):
            at, out = 0, []
            for piece in raw:
                out.append((at, at + len(piece)))
                at += len(piece)
            spans.append(out)
        links = [
            (a, b) for a, (s, e) in zip(ids_a, spans[0]) for b, (t, f) in zip(ids_b, spans[1]) if s < f and t < e
        ]
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        for end in both:
            sides = [
                ",".join(str(i) for i, (s, e) in zip(ids, span) if start <= s and e <= end)
                for ids, span in zip((ids_a, ids_b), spans)
            ]
            groups.append("|".join(sides))
            start = end
        docs.update(set(links))
        found.append((len(ids_a), len(ids_b), links, groups))
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), f in zip(rows, found):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = f
        n_best = sum(docs[link] == best[link[0]] for link in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(docs[k] for k in links), sha(";".join(groups))))
    return out, docs, best


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 20])
def test_alignment_equals_brute_force(spark, rows, block_bytes):
    few = [r for r in rows if len(r[1] or "") < 700]
    want, docs, best = plain_alignment([r[:2] for r in few])
    table = spark.createDataFrame(few, SCHEMA).repartition(3)
    got = alignment.alignment_report(table, block_bytes=block_bytes)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    same(got.collect(), want)
    if block_bytes == 300:
        _, counts = alignment.align(table, block_bytes=block_bytes)
        same(counts.collect(), [(a, b, n, str(n == best[a]).lower() == "true") for (a, b), n in docs.items()])


def test_long_texts_are_aligned(spark):
    long = "word, another-one\n" * 30_000
    rows = spark.createDataFrame([(1, long), (2, "x"), (3, long)], "doc_id long, text string")
    got = {r.doc_id: r for r in alignment.alignment_report(rows).collect()}
    assert got[1].n_a > 100_000 and got[1][1:] == got[3][1:]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for operator in (alignment.alignment_report, piece_table.fim_report, byte_pairs.digests):
        assert operator(none).collect() == []
