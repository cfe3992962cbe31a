from __future__ import annotations

import zlib

import numpy as np
import pytest

from trajlake.llm import idcoder, idfiles, lengths, merges, tokens
from trajlake.llm.queries import tokenizer_path

PATH = tokenizer_path()
TEXTS = ["", None, "Hello, World! it's 42nd...", "the end", " \t\n", "Ünïcode ÉÀ ½ ² ª º µ ß", "İstanbul", "日本語 text", "á b\x1cc", "don't we'll 'S x's", "!!'s ''s", "“quoted” – dash… €5", "a.b,c;d ,. .5 1,000", "<|endoftext|> x", "&&& $$$ the&&&", "word. word, WORD; word: word! word?", "x" * 5000, "non breaking\u0085space"]


def test_chunks_encode_as_the_library_does():
    from tokenizers import Tokenizer

    library, coder = Tokenizer.from_file(PATH), tokens.ChunkEncoder(PATH)
    for _ in range(2):
        for t in TEXTS:
            want = np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
            assert coder.encode(t) == want, t


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 5)
    coder = tokens.ChunkEncoder(PATH)
    t = "one two three, four. five six seven eight nine ten, eleven twelve."
    assert all(coder.encode(t) == coder.whole([t])[0] for _ in range(3))


def test_a_full_cache_keeps_what_the_last_batch_has(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CACHE", 5)
    coder = tokens.ChunkEncoder(PATH)
    first, last = pa.array(["alpha beta, gamma. delta 12 epsilon!"]), pa.array(["Zeta, eta; theta 7's iota (kappa) lambda..."])
    coder.encode_batch(first)
    ids, size = coder.encode_batch(last)
    want = coder.whole(last.to_pylist())[0]
    coder._library = coder._words = None  # no text goes there again
    again, same = coder.encode_batch(last)
    assert again.tobytes() == ids.tobytes() == want and same.tolist() == size.tolist() == [len(want) // 4]
    assert len(coder._known) < 20  # and nothing of the first batch


@pytest.mark.parametrize("ids", [[], [0], [7] * 900, list(range(3000)), [65535] * 50, [2**32 - 1, 2**32 - 2, 0, 70000] * 40, list(np.random.default_rng(0).integers(0, 49408, 5000)), list(np.tile(np.random.default_rng(1).integers(0, 300, 350), 9))])
def test_coder_round_trip(ids):
    a = np.array(ids, np.uint32)
    table = idcoder.Table.of(a)
    blocks = idcoder.encode(a, table, 512)
    table = idcoder.Table.from_bytes(table.to_bytes())
    back = idcoder.decode(blocks, table)
    assert (np.concatenate(back) if back else np.zeros(0)).tolist() == a.tolist()
    if len(blocks) > 1:
        assert idcoder.decode(blocks[1:2], table)[0].tolist() == a[512:1024].tolist()  # a block stands alone
        n, crc, code = blocks[0]
        with pytest.raises(ValueError):
            idcoder.decode([(n, crc ^ 1, code)], table)


def test_repeats_cost_less_than_noise():
    rng = np.random.default_rng(2)
    size = lambda a: sum(len(c) for _, _, c in idcoder.encode(a.astype(np.uint32), None, 4096))
    assert size(np.tile(rng.integers(0, 50000, 64), 64)) < size(rng.integers(0, 50000, 4096)) / 8
    with pytest.raises(ValueError):
        idcoder.encode(np.array([1], np.uint32), None, idcoder.MOST + 1)


def test_more_ids_than_ranks_of_their_own():
    a = np.random.default_rng(4).zipf(1.1, 30_000) % 45_000
    table = idcoder.Table.of(a)
    assert len(table.ids) > idcoder.DENSE
    assert (np.concatenate(idcoder.decode(idcoder.encode(a, table), table)) == a).all()


def test_many_blocks_take_no_more_memory_than_the_lanes():
    import tracemalloc

    a = np.random.default_rng(5).integers(0, 5000, 8000 * 32).astype("<u4")
    table = idcoder.Table.of(a)
    peaks = []
    for work in (lambda: idcoder.encode(a, table, 32), lambda: idcoder.decode(blocks, table)):
        tracemalloc.start()
        got = work()
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
        blocks = got if len(peaks) == 1 else blocks
    assert (np.concatenate(got) == a).all()
    assert max(peaks) < 100  # 25 KB for each of 8,000 blocks would be 200


def test_lanes_do_not_show_in_the_code(monkeypatch):
    a = np.random.default_rng(6).zipf(1.2, 9_000) % 6_000
    table = idcoder.Table.of(a)
    whole = idcoder.encode(a, table, 256)
    monkeypatch.setattr(idcoder, "LANES", 7)
    monkeypatch.setattr(idcoder, "READ_LANES", 5)
    assert idcoder.encode(a, table, 256) == whole
    assert (np.concatenate(idcoder.decode(whole, table)) == a).all()


def test_the_code_of_round_2_is_still_read_and_written():
    n = np.arange(30_000)
    a = (n**2 // 7 % 4001 * (n % 3 > 0) + n % 5 * 1100).astype("<u4")
    blocks = idcoder.encode(a, None, 512)
    assert zlib.crc32(b"".join(code for _, _, code in blocks)) == 2538298554
    assert (np.concatenate(idcoder.decode(blocks, idcoder.Table.of(a))) == a).all()


def test_rows_of_sums_are_cache_lines():
    model = idcoder._Model(idcoder.Table.of(np.arange(3000)), 5)
    assert model.lines.itemsize == 64 and model.lines.ctypes.data % 64 == 0


def test_files_are_smaller_than_counts_alone_would_make_them():
    """Whole files of sf0.01 stay below the entropy of their own ids' counts, which no coder without contexts or adaptation can."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).combine_chunks()
    ids, size = tokens.ChunkEncoder(PATH).encode_batch(texts)
    share = np.bincount(ids) / len(ids)
    share = share[share > 0]
    entropy = -(share * np.log2(share)).sum() / 8
    data = idfiles.pack(list(range(len(size))), size, ids)
    assert len(data) / len(ids) < 0.95 * entropy
    assert (idfiles.unpack(data)[2] == ids).all()


def test_other_tokenizer_files_go_to_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    library, coder = Tokenizer.from_file(path), tokens.ChunkEncoder(path)
    assert not coder.fast
    for t in TEXTS:
        assert coder.encode(t) == np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_many_small_mixtures_encode_as_the_library_does():
    import pyarrow as pa
    from tokenizers import Tokenizer

    rng, letters = np.random.default_rng(0), list("abcXYZäßñ'’.,;:!?&#$*()0129²ªºµ sSt-_/\\\"é€…–")
    texts = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(3000)]
    ids, size = tokens.ChunkEncoder(PATH).encode_batch(pa.array(texts))
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and size.tolist() == list(map(len, want))
    very_long = "Straße don't, " * 200_000  # several slices of a batch, and one text longer than a slice
    batch = pa.RecordBatch.from_pydict({"t": ["a b", very_long, None, "c"]})
    parts = [tokens.ChunkEncoder(PATH).encode_batch(s.column("t"))[1] for s in tokens.slices(batch, "t", 1000)]
    assert len(parts) > 1 and np.concatenate(parts).tolist() == [2, 200_000 * len(Tokenizer.from_file(PATH).encode("Straße don't, ").ids), 0, 1]

def test_words_known_are_looked_through_once_for_several_batches(monkeypatch):
    import pyarrow as pa

    coder, tables = tokens.ChunkEncoder(PATH), []
    own = coder._table
    monkeypatch.setattr(coder, "_table", lambda chunks: tables.append(len(chunks)) or own(chunks))
    batches = [pa.array(x, pa.string()) for x in (TEXTS, [], ["the end"], [None, "", "日本語"], TEXTS[::-1], ["<|endoftext|>"])]
    got = list(coder.encode_splits([coder.split(b) for b in batches]))
    assert len(tables) == 1
    for b, (ids, size) in zip(batches, got, strict=True):
        want = coder.whole([t or "" for t in b.to_pylist()])
        assert ids.tobytes() == b"".join(want) and size.tolist() == [len(w) >> 2 for w in want]


@pytest.mark.parametrize("path", [PATH, tokenizer_path("byte_bpe_50k.json")])
def test_groups_of_slices_do_not_show_in_the_files(spark, monkeypatch, path):
    rows = [(i, "Some wörds, and " * (i % 9) + f"{i} 日本" * (i % 4 == 0)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = idfiles.read_ids(idfiles.write_ids(docs, "doc_id", "text", path, 2, file_ids=700)).orderBy("start").collect()
    monkeypatch.setattr(idfiles, "SLICE", 64)  # batches and groups of a few texts
    got = idfiles.read_ids(idfiles.write_ids(docs, "doc_id", "text", path, 2, file_ids=700)).orderBy("start").collect()
    assert got == want and len(got) == 200


def test_files_in_key_order(spark):
    rows = [(i * 7 % 50, f"text number {i} " * (i % 5), 0) for i in range(50)] + [(None, "no key", 1), (3, "again", 2), (99, None, 3)]
    manifest = idfiles.write_ids(spark.createDataFrame(rows, "doc_id long, text string, part int"), "doc_id", "text", PATH, 2, file_ids=60, block=16)
    assert manifest.count() > 4
    got = idfiles.read_ids(manifest).orderBy("start").collect()
    want = sorted(((k is not None, k or 0, t or ""), k, t) for k, t, _ in rows)
    coder, start = tokens.ChunkEncoder(PATH), 0
    assert len(got) == len(rows)
    for r, (_, k, t) in zip(got, want, strict=True):
        ids = coder.encode(t) + b"\x02\0\0\0"
        assert tuple(r) == (k, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert idfiles.read_ids(idfiles.write_ids(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text", PATH, 2)).count() == 0


def test_texts_come_in_batches_of_a_slice(spark, monkeypatch):
    key, own, seen = "spark.sql.execution.arrow.maxBytesPerBatch", idfiles.stage, []
    before = spark.conf.get(key)
    monkeypatch.setattr(idfiles, "stage", lambda df, what: seen.append(spark.conf.get(key)) or own(df, what))
    docs = spark.createDataFrame([(1, "one"), (2, "two words")], "doc_id long, text string")
    assert idfiles.read_ids(idfiles.write_ids(docs, "doc_id", "text", PATH, 2)).count() == 2
    assert seen == [str(tokens.SLICE)] and spark.conf.get(key) == before


def test_words_reach_the_library_at_the_byte_level():
    from tokenizers import Tokenizer, pre_tokenizers

    letters = [chr(c) for c in range(0x61, 0x250) if chr(c).isalpha() and chr(c).islower()]
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    word = "".join(letters)
    assert word.encode().decode("latin-1").translate(tokens._LEVEL) == level.pre_tokenize_str(word)[0][0]
    coder, library = tokens.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    words = [a + b for a in letters[::7] for b in letters]
    ids, size = coder._of_words(words)
    want = [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and size.tolist() == list(map(len, want))


def test_new_words_are_merged_without_the_library():
    import pyarrow as pa

    coder = tokens.ChunkEncoder(PATH)
    rng, letters = np.random.default_rng(8), np.array(list("aaeeiioouunrstlcdmpéèñüßøz"))
    words = sorted({"".join(rng.choice(letters, n)) for n in rng.integers(1, 30, 20_000)} - {""})
    short = [w for w in words if len(w.encode()) <= merges.LONGEST]
    assert len(words) > len(short) > merges.WORDS
    want, size = coder._of_words(words)
    want = np.split(want, np.cumsum(size)[:-1])
    want = [w for w, of in zip(want, words, strict=True) if len(of.encode()) <= merges.LONGEST]
    coder._library = coder._words = None
    ids, size = coder.encode_batch(pa.array([" ".join(short), "", short[0]]))
    assert ids.tolist() == np.concatenate([*want, want[0]]).tolist()
    assert size.tolist() == [sum(map(len, want)), 0, len(want[0])]
    other = tokens.ChunkEncoder(PATH)
    other._merges = None  # as for a file whose merges aren't of this form
    assert other.encode_batch(pa.array([" ".join(short), "", short[0]]))[0].tobytes() == ids.tobytes()


def test_merges_of_equal_number_go_from_the_left_and_each_pair_has_its_own():
    import pyarrow as pa

    byte = np.arange(256)
    own = merges.Merges(byte, byte + 256, np.array([[97, 97], [600, 600], [97, 98 + 256]]), np.array([600, 601, 602]))
    ids, size = own.encode(pa.array(["aaaaab", "aab", "b", "a" * merges.LONGEST]))
    assert size.tolist() == [2, 2, 1, 9] and ids.tolist()[:5] == [601, 602, 600, 354, 354]
    with pytest.raises(ValueError):
        merges.Merges(byte, byte + 256, np.array([[97, 97], [97, 97]]), np.array([600, 601]))
    with pytest.raises(ValueError):
        merges.Merges(byte, byte + 70_000, np.array([[97, 97]]), np.array([600]))


def test_damaged_files_are_refused():
    data = bytearray(idfiles.pack([1, None], [2, 1], np.array([5, 6, 7], "<u4")))
    keys, counts, ids = idfiles.unpack(bytes(data))
    assert keys == [1, None] and counts.tolist() == [2, 1] and ids.tolist() == [5, 6, 7]
    for place in (0, 10, len(data) - 20, len(data) - 1):
        bad = bytearray(data)
        bad[place] ^= 64
        with pytest.raises(ValueError):
            idfiles.unpack(bytes(bad))


def test_length_table_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lengths, "SPAN", 4)
    texts = [None, "", "a", "a b", "a b", "a b c d e f g h i j", "x " * 40]
    h = lengths.length_histogram(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, length int"), "text", PATH)
    coder = tokens.ChunkEncoder(PATH)
    n = np.array([len(coder.encode(t)) // 4 for t in texts])
    got = {r["length"]: r for r in lengths.context_table(h).collect()}
    assert sorted(got) == sorted(set(n.tolist()))
    for limit, r in got.items():
        assert r["n_docs"] == (n == limit).sum() and r["docs_at_least"] == (n >= limit).sum() and r["tokens_at_least"] == n[n >= limit].sum()
        assert r["truncated_total"] == np.minimum(n, limit).sum() and r["tokens_cut"] == n.sum() - r["truncated_total"]
        assert np.isclose(r["quantile"], (n <= limit).mean())
    assert {r["limit"]: r["total"] for r in lengths.truncated_total(h, [0, 3, 100]).collect()} == {x: np.minimum(n, x).sum() for x in (0, 3, 100)}
    assert lengths.context_table(lengths.length_histogram(spark.createDataFrame([], "text string"), "text", PATH)).count() == 0
