"""Token ids of whole texts, a column of words at a time.

White space always ends a token of the word tokenizer, so a text's ids are those of its words in
turn. A batch's distinct words are encoded once, their ids are then gathered for every text.
Most words are letters of the Latin blocks and then ASCII marks; the tokenizer splits there and
lowers A-Z, so such words share the ids of their letters and of their marks. All other words are
given to the tokenizer as they are.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from saleslake.llm.files import give_back_memory

# an ASCII control character that is no white space: one token, and rare in texts
_BREAK = "\x1f"
_JOINED = 500
_SIMPLE = (
    r"^(?P<letters>[A-Za-z\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{024F}]*)"
    r"(?P<marks>[.,;:!?*#$%&()\-]*)$"
)
TEXT_BYTES_AT_ONCE = 4 << 20
_ROWS_AT_ONCE = 200
KNOWN_STRINGS = 150_000
_GATHERED_AT_ONCE = 1 << 18


@lru_cache(maxsize=4)
def _tokenizer(path: str, plain_specials: bool) -> Tokenizer:
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = plain_specials
    return made


@lru_cache(maxsize=4)
def _known(path: str, plain_specials: bool) -> dict[str, bytes]:
    """Ids of strings that a worker has met, up to ``KNOWN_STRINGS``, as 32-bit numbers."""
    return {}


def _string_ids(path: str, plain_specials: bool, strings: list[str]) -> list[bytes]:
    known = _known(path, plain_specials)
    new = [s for s in strings if s not in known]
    made = dict(zip(new, _joined_ids(_tokenizer(path, plain_specials), new), strict=True))
    out = [made[s] if s in made else known[s] for s in strings]
    for s, ids in made.items():
        if len(known) >= KNOWN_STRINGS:
            break
        if len(s) <= 64:
            known[s] = ids
    return out


def _joined_ids(tokenizer: Tokenizer, strings: list[str]) -> list[bytes]:
    """The ids of each string, many to a call, with a break between them."""
    mark = tokenizer.encode(_BREAK, add_special_tokens=False).ids
    out = [b""] * len(strings)
    plain = [i for i, s in enumerate(strings) if s and _BREAK not in s]
    for i, s in enumerate(strings):
        if _BREAK in s:
            out[i] = np.array(tokenizer.encode(s, add_special_tokens=False).ids, np.uint32).tobytes()
    if len(mark) != 1:
        for i in plain:
            out[i] = np.array(tokenizer.encode(strings[i], add_special_tokens=False).ids, np.uint32).tobytes()
        return out
    for at in range(0, len(plain), _JOINED):
        some = plain[at : at + _JOINED]
        text = f" {_BREAK} ".join(strings[i] for i in some)
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        ends = (4 * np.r_[np.flatnonzero(ids == mark[0]), len(ids)]).tolist()
        begin, blob = 0, ids.tobytes()
        for i, end in zip(some, ends, strict=True):
            out[i] = blob[begin:end]
            begin = end + 4
    return out


def _ragged(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    return np.frombuffer(b"".join(parts), np.uint32), np.r_[0, np.cumsum(lengths)]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces of ``flat`` one after the other."""
    upto = np.r_[0, np.cumsum(lengths)]
    out = np.empty(int(upto[-1]), flat.dtype)
    for a in range(0, len(starts), _GATHERED_AT_ONCE):
        b = min(a + _GATHERED_AT_ONCE, len(starts))
        place = np.repeat(starts[a:b] - upto[a:b], lengths[a:b])
        place += np.arange(upto[a], upto[b])
        out[upto[a] : upto[b]] = flat[place]
    return out


def _word_ids(words: pa.Array, path: str, plain_specials: bool) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of these distinct words, and where each begins."""
    simple = pc.extract_regex(words, _SIMPLE)
    letters = pc.ascii_lower(simple.field("letters")).dictionary_encode()
    marks = simple.field("marks").dictionary_encode()
    odd = pc.invert(pc.is_valid(simple)).to_numpy(zero_copy_only=False)
    parts = [letters.dictionary, marks.dictionary, words.filter(pa.array(odd))]
    strings = [s for part in parts for s in part.to_pylist()]
    flat, offsets = _ragged(_string_ids(path, plain_specials, strings))
    none = len(strings)  # an entry without ids
    offsets = np.r_[offsets, offsets[-1]]
    first = pc.fill_null(letters.indices, none).to_numpy(zero_copy_only=False).astype(np.int64)
    second = pc.fill_null(pc.cast(marks.indices, pa.int64()), -1).to_numpy(zero_copy_only=False)
    second = np.where(second < 0, none, second + len(parts[0]))
    first[odd] = len(parts[0]) + len(parts[1]) + np.arange(int(odd.sum()))
    second[odd] = none
    both = np.stack([first, second], axis=1).ravel()
    lengths = offsets[both + 1] - offsets[both]
    return gather(flat, offsets[both], lengths), np.r_[0, np.cumsum(lengths.reshape(-1, 2).sum(axis=1))]


def encode(
    texts: pa.Array, path: str, end_id: int, plain_specials: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, each closed by ``end_id``, and where each begins.

    Null texts count as empty. With ``plain_specials`` the strings of special tokens in a text
    are ordinary text.
    """
    lines = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\n", " ")
    words = pc.split_pattern(lines, " ")
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    del lines, words
    flat, offsets = _word_ids(coded.dictionary.cast(pa.string()), path, plain_specials)
    # the end id is one more word, placed after the words of each text
    flat, offsets = np.r_[flat, np.uint32(end_id)], np.r_[offsets, offsets[-1] + 1]
    ends = np.cumsum(sizes)
    index = np.insert(coded.indices.to_numpy(zero_copy_only=False), ends, len(offsets) - 2)
    del coded
    starts, lengths = offsets[index], np.diff(offsets)[index]
    del index
    upto = np.r_[0, np.cumsum(lengths)]
    return gather(flat, starts, lengths), upto[np.r_[0, ends + np.arange(1, len(ends) + 1)]]


def grouped(batches, column: int):
    """Record batches taken apart into tables of a few MB of text, whole rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            part = batch.slice(at, _ROWS_AT_ONCE)
            held.append(part)
            size += part.column(column).nbytes
            if size >= TEXT_BYTES_AT_ONCE:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                give_back_memory()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
    give_back_memory()
