"""BPE: ids and decoding against the tokenizers library, and edge rows."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from itemscope.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
EDGE = ["", None, "ΑΣ ΣΑΣ. İstanbul ǅ straße ﬁ", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "a\x1cb \x85 c d é ́x",
        "it's I'LL 'S ''s we'vex 12 345 ½ ²x Ⅷ", "日本語 テスト한국어 😀😀👍🏽", " ​ x\xa0y", "x" * 500, "\x00\x01a\x7f", "a_b__c",
        "aaaaaaaaaaaaaaaa", "hello " * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_edge_texts(spark, library):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(EDGE + EDGE[:2])], "doc_id bigint, text string, t string")
    got = bpe.apply(df, PATH, decoded="decoded").collect()
    assert len(got) == len(EDGE) + 2
    for r in got:
        assert (r.ids, r.decoded) == _expected(library, r.text) and r.t == "x"


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in bpe.apply(docs, PATH, decoded="decoded").collect():
        assert (r.ids, r.decoded) == _expected(library, r.text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    library = Tokenizer.from_file(PATH)
    v = bpe._vocabulary(bpe._read(PATH))
    chunks = bpe._chunks(text)
    v.learn(set(chunks))
    packed = v.encode(chunks)
    assert [int.from_bytes(packed[i:i + 4], "little") for i in range(0, len(packed), 4)] == library.encode(text, add_special_tokens=False).ids


def test_small_cache_and_slices_change_nothing(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "SLICE_CHARS", 16)
    text = "one two three four five six, seven's eight\nnine ten " * 4
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([text, "a", None])], names=["t"])
    bpe._LOADED.clear()
    out = next(bpe.encoder(bpe._read(PATH), 0, "ids")(iter([batch])))
    bpe._LOADED.clear()
    assert out.column("ids").to_pylist()[0] == library.encode(text, add_special_tokens=False).ids


def test_decode_alone_and_empty_table(spark, library):
    df = spark.createDataFrame([(1, [1, 2, 49407]), (2, []), (3, None)], "k bigint, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decode(df, PATH).collect()}
    assert got == {1: library.decode([1, 2, 49407], skip_special_tokens=False), 2: "", 3: ""}
    assert bpe.apply(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0


def test_memory_is_linear_in_a_word(library):
    import random
    import tracemalloc

    rng = random.Random(3)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(20000))
    v = bpe._vocabulary(bpe._read(PATH))
    tracemalloc.start()
    try:
        packed = v.walk([word])[word]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [int.from_bytes(packed[i:i + 4], "little") for i in range(0, len(packed), 4)] == library.encode(word, add_special_tokens=False).ids
    assert peak < 30_000_000


LATIN = "aeßñÉÀÿŁıſµªº 0129²½'sstreveml!?._-«»<|>\n\t"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=LATIN, max_size=80))
def test_latin_text_as_a_whole(text):
    v = bpe._vocabulary(bpe._read(PATH))
    latin, units = v.units(text)
    packed = v.encode(units, latin)
    library = v.library.encode(text, add_special_tokens=False).ids
    assert latin and [int.from_bytes(packed[i:i + 4], "little") for i in range(0, len(packed), 4)] == library


def test_next_task_of_a_worker_walks_no_word_again(library, monkeypatch):
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["Some words, some 'words' again 12", None, "naïve ½ ﬁ words"])], names=["t"])
    walked = []
    plain = bpe._Vocabulary.walk
    monkeypatch.setattr(bpe._Vocabulary, "walk", lambda self, words: walked.extend(words := list(words)) or plain(self, words))
    bpe._LOADED.clear()
    for _ in range(2):
        out = next(bpe.encoder(bpe._read(PATH), 0, "ids")(iter([batch])))
        assert out.column("ids").to_pylist() == [library.encode(t or "", add_special_tokens=False).ids for t in batch.column(0).to_pylist()]
    assert len(walked) == len(set(walked)) > 5


def test_recent_forgets_what_was_not_asked_for():
    from itemscope.llm.common import Recent
    known = Recent()
    for keys in ({1, 2}, {2, 3}, {2, 4}, {2, 5}, {1, 2}):
        new = known.missing(keys, 6)
        known.now.update({k: -k for k in new})
        assert {k: known.now[k] for k in keys} == {k: -k for k in keys}
        assert len(known.now) <= 3
        if keys == {2, 5}:
            assert new == {5}
    assert new == {1}


def test_words_of_a_batch_are_learnt_in_parts(monkeypatch):
    """A batch's words are not held at once: a part of it at a time, with the same ids."""
    import pyarrow as pa

    content = bpe._read(PATH)
    texts = [" ".join(f"wörd{i}x{k} 漢字{i}" for k in "abcdefgh") if i % 9 else None for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"])
    whole = next(bpe.encoder(content, 0, "ids")(iter([batch]))).column(1).to_pylist()
    learnt = []
    learn = bpe._Vocabulary.learn
    monkeypatch.setattr(bpe._Vocabulary, "learn", lambda self, *a: (learnt.append(sum(map(len, a))), learn(self, *a))[1])
    monkeypatch.setattr(bpe, "HELD_CHARS", 200, raising=False)
    assert next(bpe.encoder(content, 0, "ids")(iter([batch]))).column(1).to_pylist() == whole
    assert max(learnt) <= 60
