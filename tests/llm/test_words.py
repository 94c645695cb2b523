import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.common import ALPHANUMERIC, SPACED, text_blocks, word_count, word_hashes, word_spans


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


@pytest.mark.parametrize("kind, pattern", [(SPACED, r"[^\x20\x09-\x0D]+"),
                                           (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_words_of_blocks_are_those_of_the_pattern(prose, kind, pattern, limit):
    texts = prose(300) + ["x" * 100 + " " + "Y" * 100, "a_b-c\x00d\x7fe", "\x0b\x1fq", None, ""]
    by_word, by_hash = {}, {}
    seen = 0
    for first, last, data, offsets in text_blocks(pa.array(texts, pa.string()), limit):
        assert first == seen
        seen = last
        starts, ends, bounds = word_spans(data, offsets, kind)
        hashes = word_hashes(data, starts, ends)
        for i in range(first, last):
            own = slice(bounds[i - first], bounds[i - first + 1])
            words = re.findall(pattern, lowered(texts[i] or ""))
            found = [lowered(bytes(data[a:b]).decode()) for a, b in zip(starts[own], ends[own])]
            assert found == words
            for w, h in zip(words, hashes[own].tolist()):
                assert by_word.setdefault(w, h) == h and by_hash.setdefault(h, w) == w
    assert seen == len(texts)


def test_long_words_and_slices():
    column = pa.array(["skip", "a" * 3_000_000 + " b", None, "a b c"]).slice(1)
    assert word_count(column).tolist() == [2, 0, 3]
    (_, _, data, offsets), *_ = list(text_blocks(column))
    starts, ends, _ = word_spans(data, offsets, SPACED)
    assert len(np.unique(word_hashes(data, starts, ends))) == 2
    assert word_count(pa.array([], pa.string())).tolist() == []
