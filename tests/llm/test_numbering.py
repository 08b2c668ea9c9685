import numpy as np
import pyarrow as pa

from ledgerloom.llm.numbering import Numbers, Sums, Waiting, binary, distinct_pairs, hashes_of, split


def test_split_and_numbers():
    words, text = split(binary([b"", b"  a b\tc ", b" ", b"\xff a"]))
    assert words.to_pylist() == [b"a", b"b", b"c", b"\xff", b"a"] and text.tolist() == [1, 1, 1, 3, 3]
    numbers = Numbers()
    assert numbers.of(words).tolist() == [0, 1, 2, 3, 0]
    assert numbers.of(binary([b"z", b"c"])).tolist() == [4, 2] and len(numbers) == 5
    assert numbers.of(binary()).tolist() == []


def test_hashes_depend_on_content_only():
    values = [b"", b"a", b"abcdefgh", b"abcdefghi", b"abcdefgh" * 9, b"a\x00", b"a\x00\x00"]
    whole = hashes_of(binary(values), 7)
    assert len(set(whole.tolist())) == len(values)
    for i, value in enumerate(values):
        assert hashes_of(binary([b"shift", value])[1:], 7).tolist() == [whole[i]]
    prefixes = hashes_of(binary(values), 7, 8)
    assert prefixes[3] == prefixes[4] != prefixes[2] == whole[2]
    assert hashes_of(binary([b"abcdefgh"]), 7, None, np.array([True]))[0] == prefixes[3]
    assert hashes_of(binary(values), 8)[1] != whole[1] and len(hashes_of(binary(), 7)) == 0


def test_pairs_and_sums():
    first, second = distinct_pairs(np.array([1, 0, 1, 1]), np.array([5, 5, 4, 5]))
    assert (first.tolist(), second.tolist()) == ([0, 1, 1], [5, 4, 5])
    sums = Sums()
    sums.add(np.array([1, 1, 0]), np.array([2, 2, 3]))
    sums.add(np.array([1]), np.array([2]))
    assert [c.tolist() for c in sums.together()] == [[0, 1], [3, 2], [1, 3]]
    assert [len(c) for c in Sums().together()] == [0, 0, 0]


def test_waiting_loses_no_row():
    waiting, seen = Waiting(200, 1), []
    for start in range(0, 100, 10):
        batch = pa.RecordBatch.from_arrays([pa.array(["ab"[i % 2] if i < 90 else "c" for i in range(start, start + 10)]), pa.array(range(start, start + 10))], names=["k", "v"])
        seen += waiting.add(batch)
    seen += waiting.rest()
    assert sorted((k, v) for k, (c,) in seen for v in c.to_pylist()) == sorted(("ab"[i % 2] if i < 90 else "c", i) for i in range(100))
