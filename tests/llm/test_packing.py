import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from stratum.llm import packing
from stratum.llm.packing import TextTokenizer, difference, pack_documents, pack_whole, vocabulary_path

from ..conftest import SF_SMALL


def test_token_ids_are_those_of_the_vocabulary_file():
    whole = Tokenizer.from_file(vocabulary_path())
    own = TextTokenizer(vocabulary_path())
    for text in ["", " ", "a  b\n\n c \n d  ", "it's 's  \t x", "x<|endoftext|>y", "aé漢字 ² ½ 12", "\u3000 z", "w" * 5000]:
        assert own.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_differencing_gives_near_equal_windows():
    rnd = random.Random(2)
    sizes = [rnd.randint(1, 100) for _ in range(200)]
    packed = difference(sizes, 10)
    loads = [sum(sizes[i] for i in w) for w in packed]
    assert sorted(i for w in packed for i in w) == list(range(200)) and max(loads) - min(loads) <= 2


def test_window_count_rises_until_nothing_exceeds_the_capacity():
    assert [len(pack_whole(s, 10)) for s in ([6, 6, 6], [5, 5, 5, 5], [10], [], [6, 5, 5, 4])] == [3, 2, 1, 0, 2]
    with pytest.raises(ValueError):
        pack_whole([11], 10)


def test_the_count_rises_in_the_query_s_own_path_and_few_pieces_are_cut(monkeypatch):
    rnd = random.Random(4)
    pieces = [(i, 0, rnd.randint(1, 1023)) for i in range(256)]
    counts = []
    plain = packing.difference
    monkeypatch.setattr(packing, "difference", lambda sizes, n: counts.append(n) or plain(sizes, n))
    packed, left = packing.pack_group(pieces, 1024)
    total = sum(p[2] for p in pieces)
    assert len(packed) == total // 1024 and len(counts) > 1 and counts == sorted(set(counts))
    assert all(sum(p[2] for p in w) == 1024 for w in packed) and sum(p[2] for p in left) == total % 1024
    whole = {(d, s, n) for w in packed for d, s, n in w} & set(pieces)
    assert len(whole) > 0.75 * len(pieces)
    spans = {}
    for d, s, n in [p for w in (*packed, left) for p in w]:
        spans.setdefault(d, []).append((s, n))
    for d, _, n in pieces:
        own = sorted(spans[d])
        assert [a for a, _ in own] == [0, *np.cumsum([x for _, x in own])[:-1]] and sum(x for _, x in own) == n


def test_only_what_whole_windows_leave_is_held():
    texts = [np.arange(8 * 1000 + 3, dtype="<u4") for _ in range(5)]
    got = [p for seq in packing.pack_stream(iter(texts), 8, 3) for p in seq]
    assert sum(p[2] for p in got) == sum(map(len, texts))
    assert all((p[3] == np.arange(p[1], p[1] + p[2])).all() and p[4] == 8003 for p in got)


@pytest.mark.parametrize("group", [2, 256])
def test_every_id_lies_in_one_piece_without_padding(spark, group):
    whole = Tokenizer.from_file(vocabulary_path())
    texts = [None, "", "long " * 20_000] + [r.text for r in spark.read.parquet(
        f"{SF_SMALL}/documents.parquet").select("text").limit(150).collect()]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, start int") \
        .repartition(3)
    got = pack_documents(docs, group=group, with_ids=True).collect()
    ids = [[*whole.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    pieces, sequences = {}, {}
    for r in got:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids == own and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, own in pieces.items():
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]]
        assert sum(n for _, n in own) == len(ids[doc])
    assert len(pieces) == len(texts)
    short = 0
    for own in sequences.values():
        assert [a for a, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]]
        n = sum(n for _, n in own)
        assert n <= 1024 and n & (n - 1) == 0  # a power of two is not padded
        short += n < 1024
    assert short <= 3 * 10


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
