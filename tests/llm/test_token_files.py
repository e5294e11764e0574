import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linetally.llm.range_coder import Damaged, read_segment, write_segment
from linetally.llm.token_files import read_tokens, write_tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("kind", ["none", "one", "random", "constant", "cycle", "skewed"])
def test_round_trip(kind):
    rng = np.random.default_rng(1)
    ids = {
        "none": np.zeros(0, int), "one": np.array([65535]), "random": rng.integers(0, 65536, 9000), "constant": np.zeros(9000, int),
        "cycle": np.tile([7, 70, 7000], 3000), "skewed": rng.zipf(1.3, 30000) % 50257,
    }[kind].astype(np.uint16)
    data = write_segment([1, None], [3, len(ids) - 3], ids, block=1000)
    docs, lengths, back = read_segment(data)
    assert docs == [1, None] and lengths.tolist() == [3, len(ids) - 3] and (back == ids).all() and len(back) == len(ids)
    if len(ids) > 2000:  # any block alone
        assert (read_segment(data, only=1)[2] == ids[1000:2000]).all()


def test_models_learn():
    text = np.tile(np.random.default_rng(0).integers(0, 50000, 100), 300).astype(np.uint16)
    assert len(write_segment([1], [len(text)], text)) < len(text) / 4


def test_damage_is_found():
    ids = (np.random.default_rng(1).zipf(1.3, 20000) % 50257).astype(np.uint16)
    data = bytearray(write_segment([1], [len(ids)], ids))
    for at in (10, len(data) // 2, len(data) - 100):
        broken = bytearray(data)
        broken[at] ^= 0x55
        with pytest.raises(Damaged):
            read_segment(bytes(broken))


def test_files_in_order(spark, frame, edge, tmp_path):
    rows = [(i, t) for i, t in edge] + [(50 - i, f"number {i}") for i in range(30)]
    write_tokens(frame(rows), BYTES, f"{tmp_path}/t", segment_ids=5000)
    got = read_tokens(spark, f"{tmp_path}/t").toPandas().sort_values("start")
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    ids = [i for i in got["doc_id"].astype("Int64").fillna(-1)]
    assert ids == sorted(ids) and ids == sorted(-1 if i is None else i for i, _ in rows)
    assert (got.start == got.n_tokens.cumsum() - got.n_tokens).all()
    want = sorted(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in rows)
    assert sorted(got.ids) == want
    assert [zlib.crc32(x) for x in got.ids] == got.ids_crc32.tolist()


def test_empty(spark, frame, tmp_path):
    write_tokens(frame([]), BYTES, f"{tmp_path}/t")
    assert read_tokens(spark, f"{tmp_path}/t").count() == 0
