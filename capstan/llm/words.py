"""Tokenizing each different word of some texts once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text that a worker splits into words at a time.
BYTES_AT_ONCE = 8 << 20
# A space between white space, in the syntax of Arrow's expressions.
_WHITE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
_SPACE_RUN = f"{_WHITE} {_WHITE}"
# Words that would make such a run with their neighbours.
_OPEN_WORD = f"^$|^{_WHITE}|{_WHITE}$"


def some_texts(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``BYTES_AT_ONCE`` of text."""
    sizes = np.cumsum(pc.binary_length(batch.column(text)).to_numpy().astype(np.int64))
    cuts = np.append(np.nonzero(np.diff(sizes // BYTES_AT_ONCE))[0] + 1, batch.num_rows)
    start = 0
    for stop in cuts.tolist():
        if stop > start:
            yield batch.slice(start, stop - start)
        start = stop


def ids_by_word(
    texts: pa.StringArray,
    whole: Callable[[str], np.ndarray],
    each: Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]],
) -> list[np.ndarray]:
    """The token ids of each text, for patterns that split before a single space.

    Text between two single spaces then splits the same with and without its
    surroundings, unless a space stands between white space; such texts go
    through ``whole``. Of the others the different words go through ``each``,
    which gives the ids of all of them, a space before every word, and how many
    each has; they are dealt out to where the words stand. Words that are empty
    or begin or end with white space go one by one.
    """
    alone = pc.match_substring_regex(texts, _SPACE_RUN).to_numpy(zero_copy_only=False)
    at = np.nonzero(~alone)[0]
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
    for i in np.nonzero(alone)[0].tolist():
        out[i] = whole(texts[i].as_py())
    if not len(at):
        return out
    split = pc.split_pattern(texts.take(pa.array(at)), " ")
    starts = np.cumsum(np.append(0, pc.list_value_length(split).to_numpy()[:-1]))
    words = split.flatten()
    # The first word of a text has no space before it.
    single = [whole(w) for w in words.take(pa.array(starts)).to_pylist()]
    listed = words.dictionary_encode()
    different = listed.dictionary
    is_open = pc.match_substring_regex(different, _OPEN_WORD)
    single += [whole(" " + w) for w in different.filter(is_open).to_pylist()]
    joined = different.filter(pc.invert(is_open))
    ids, sizes = each(joined) if len(joined) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    # Joined words come first, then the first words of the texts, then the open ones.
    mask = is_open.to_numpy(zero_copy_only=False)
    place = np.where(mask, len(joined) + len(at) + np.cumsum(mask) - 1, np.cumsum(~mask) - 1)
    code = place[listed.indices.to_numpy()]
    code[starts] = len(joined) + np.arange(len(at))
    ids = np.concatenate([ids, *single])
    sizes = np.append(sizes, [len(s) for s in single]).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    counts = sizes[code]
    ends = np.cumsum(counts)
    dealt = ids[np.repeat(begins[code] - (ends - counts), counts) + np.arange(ends[-1])]
    for i, part in zip(at.tolist(), np.split(dealt, ends[starts[1:] - 1]), strict=True):
        out[i] = part
    return out


def ends_of(words: pa.StringArray) -> np.ndarray:
    """Where each word ends, in bytes, in the text of all words with a space before each."""
    return np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64) + 1)
