"""The segment envelope: an Avro record whose only field is a list of strings or null.

On the wire: branch 0 and blocks of length-prefixed strings, ended by an empty
block, or branch 1 for null; numbers are zig-zag variable-length integers.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Send the decoder itself to the Python workers, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Schema text for Spark's own Avro connector. Names do not reach the bytes.
SEGMENT_SCHEMA = """
{"type": "record", "name": "segment", "fields": [
  {"name": "list", "type": [{"type": "array", "items": "string"}, "null"]}]}
"""

NULL_SEGMENT = "02"
EMPTY_SEGMENT = "0000"
MAX_VARINT_BYTES = 10


def _varint(number: Column) -> Column:
    """Bytes of a non-negative int, as text that is only ever concatenated."""
    zigzag = number.cast("bigint") * 2

    def digits(septets: int) -> Column:
        out = []
        for k in range(septets):
            byte = F.shiftright(zigzag, 7 * k)
            byte = byte if k == septets - 1 else (byte.bitwiseAND(F.lit(127))).bitwiseOR(F.lit(128))
            out.append(F.lpad(F.hex(byte), 2, "0"))
        return F.concat(*out) if septets > 1 else out[0]

    encoded = digits(5)
    for septets in (4, 3, 2, 1):
        encoded = F.when(zigzag < (1 << 7 * septets), digits(septets)).otherwise(encoded)
    return F.unhex(encoded).cast("string")


def frame(line: Column) -> Column:
    """One line with its length in front."""
    return F.concat(_varint(F.octet_length(line)), line)


def seal(frames: Column, count: Column) -> Column:
    """Message bytes of an array of `count` framed lines."""
    body = F.concat(F.lit("\0"), _varint(count), F.array_join(frames, ""), F.lit("\0"))
    return F.when(count == 0, F.unhex(F.lit(EMPTY_SEGMENT))).otherwise(body.cast("binary"))


def encode(lines: Column) -> Column:
    """Message bytes of an array of lines.

    A NULL array is the null branch. An array that holds a NULL has no encoding
    and gives NULL.
    """
    return (
        F.when(lines.isNull(), F.unhex(F.lit(NULL_SEGMENT)))
        .when(F.exists(lines, lambda x: x.isNull()), F.lit(None).cast("binary"))
        .otherwise(seal(F.transform(lines, frame), F.size(lines)))
    )


def _read_long(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    for at in range(at, at + MAX_VARINT_BYTES):
        byte = data[at]
        value |= (byte & 127) << shift
        if byte < 128:
            return (value >> 1) ^ -(value & 1), at + 1
        shift += 7
    raise IndexError("number too long")


def _places(data: bytes, at: int, end: int, left: int) -> tuple[list[int], list[int]] | None:
    """Where the lines of one message begin and how long they are, from `at` on, with `left` to come in this block."""
    starts: list[int] = []
    sizes: list[int] = []
    try:
        while True:
            if left == 0:
                left, at = _read_long(data, at)
                if left == 0:
                    return (starts, sizes) if at <= end else None
                if left < 0:
                    left = -left
                    _, at = _read_long(data, at)
            # Lengths of one and two bytes, up to 8,191, without a call.
            size = data[at]
            if size < 128:
                at += 1
            elif data[at + 1] < 128:
                size = size & 127 | data[at + 1] << 7
                at += 2
            else:
                signed, at = _read_long(data, at)
                size = signed << 1 if signed >= 0 else 1
            if size & 1:  # odd: negative
                return None
            size >>= 1
            if at + size > end:
                return None
            starts.append(at)
            sizes.append(size)
            at += size
            left -= 1
    except IndexError:
        return None


def segment_lines(data: bytes | None) -> list[bytes] | None:
    """Lines of one message; None for the null branch and for broken bytes."""
    if not data:
        return None
    try:
        branch, at = _read_long(data, 0)
    except IndexError:
        return None
    found = _places(data, at, len(data), 0) if branch == 0 else None
    return None if found is None else [data[s : s + n] for s, n in zip(*found)]


# Bytes of messages that are decoded at a time: the places of their lines take many times as much.
SLICE = 2 << 20
# Below so many unfinished messages, each is walked on its own.
FEW = 16
# Numbers from here on are larger than any message and stand for all that are.
HUGE = 1 << 54


def _read_longs(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers at many places, the places behind them, and which numbers do not end before `end`."""
    last = len(data) - 1
    byte = data[np.minimum(at, last)].astype(np.int64)
    value, after, broken = byte & 127, at + 1, at >= end
    more = np.flatnonzero((byte > 127) & ~broken)
    for k in range(1, MAX_VARINT_BYTES):
        if not len(more):
            break
        place = at[more] + k
        out = place >= end[more]
        broken[more[out]] = True
        more, place = more[~out], place[~out]
        byte = data[place].astype(np.int64)
        septet = byte & 127
        if 7 * k < 55:
            value[more] |= septet << 7 * k
        else:
            value[more[septet > 0]] |= 2 * HUGE
        after[more] += 1
        more = more[byte > 127]
    broken[more] = True
    return (value >> 1) ^ -(value & 1), after, broken


def _all_places(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Message, start and size of every line of many messages, in order, and which messages can be decoded.

    The messages are walked in lock step: each turn reads the next length of all that are not finished.
    """
    good = np.zeros(len(begin), bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # a turn gives a message one line at most
    branch, at, broken = _read_longs(data, begin, end)
    mine = np.flatnonzero(~broken & (branch == 0) & (end > begin))
    at, stop, left = at[mine], end[mine], np.zeros(len(mine), np.int64)
    while len(mine) > FEW:
        fresh = np.flatnonzero(left == 0)
        keep = np.ones(len(mine), bool)
        if len(fresh):
            count, after, broken = _read_longs(data, at[fresh], stop[fresh])
            good[mine[fresh[~broken & (count == 0)]]] = True
            keep[fresh[broken | (count == 0)]] = False
            sized = np.flatnonzero(~broken & (count < 0))
            if len(sized):
                _, after[sized], cut = _read_longs(data, after[sized], stop[fresh[sized]])
                keep[fresh[sized[cut]]] = False
            at[fresh], left[fresh] = after, np.abs(count)
            if not keep.all():
                mine, at, stop, left = mine[keep], at[keep], stop[keep], left[keep]
        size, at, broken = _read_longs(data, at, stop)
        broken |= (size < 0) | (size > stop - at)
        if broken.any():
            keep = ~broken
            mine, at, stop, left, size = mine[keep], at[keep], stop[keep], left[keep], size[keep]
        found.append((mine, at, size))
        at, left = at + size, left - 1
    for m, place, until, rest in zip(mine.tolist(), at.tolist(), stop.tolist(), left.tolist()):
        lines = _places(data[place:until].tobytes(), 0, until - place, rest)
        if lines is not None:
            good[m] = True
            starts = np.array(lines[0], np.int64) + place
            found.append((np.full(len(starts), m), starts, np.array(lines[1], np.int64)))
    if not found:
        return *np.zeros((3, 0), np.int64), good
    message, start, size = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(start)  # places in the buffer are the order of messages and of their lines
    order = order[good[message[order]]]
    return message[order], start[order], size[order], good


def _lines(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all lines, the size of each, how many each message has, and which messages can be decoded."""
    message, start, size, good = _all_places(data, begin, end)
    gap = np.append(start, len(data)) - np.insert(start + size, 0, 0)  # what lies between lines: their lengths, or no lines
    first = np.cumsum(gap) - gap
    kept = np.ones(len(data), bool)
    kept[np.repeat(np.insert(start + size, 0, 0) - first, gap) + np.arange(gap.sum())] = False
    body = data[kept]
    _texts(size, body).validate(full=True)
    return body, size.astype(np.int32), np.bincount(message, minlength=len(begin)), good


def _texts(size: np.ndarray, body: np.ndarray) -> pa.StringArray:
    ends = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=ends[1:])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(body))


def decode_batch(values: pa.Array) -> pa.Array:
    """`list<string>` for a whole Arrow batch of messages, decoded by slices of about SLICE bytes."""
    values = values.cast(pa.binary())
    _, offsets, buffer = values.buffers()
    places = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    if not len(values) or buffer is None or places[0] == places[-1]:
        return pa.nulls(len(values), pa.list_(pa.string()))
    data = np.frombuffer(buffer, np.uint8)[places[0] : places[-1]]
    cuts = places - places[0]
    begin, end = cuts[:-1], cuts[1:]
    if values.null_count:
        end = np.where(np.asarray(values.is_valid()), end, begin)
    body, used = np.empty(len(data), np.uint8), 0  # lines take no more than their messages
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    first = 0
    while first < len(values):  # whole messages; a larger one is on its own
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + SLICE, "right")) - 1)
        start, stop = cuts[first], cuts[last]
        part, *rest = _decode_slice(data[start:stop], begin[first:last] - start, end[first:last] - start)
        body[used : used + len(part)] = part
        used += len(part)
        found.append(tuple(rest))
        first = last
    size, count, good = (np.concatenate(x) for x in zip(*found))
    ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~good, False)), _texts(size, body[:used]))


def _decode_slice(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if not len(data):
        return data, np.zeros(0, np.int32), np.zeros(len(begin), np.int64), np.zeros(len(begin), bool)
    try:
        return _lines(data, begin, end)
    except pa.ArrowInvalid:  # some line of the slice is not UTF-8
        message, start, size, good = _all_places(data, begin, end)
        for m in np.flatnonzero(good):
            first, last = np.searchsorted(message, [m, m + 1])
            if not _is_text(data, start[first:last], size[first:last]):
                end[m] = begin[m]
        return _lines(data, begin, end)


def _is_text(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bool:
    try:
        for start, size in zip(starts, sizes):
            data[start : start + size].tobytes().decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def decode(value: Column) -> Column:
    """Lines of message bytes, Arrow batch by Arrow batch; NULL where there are none."""

    @F.arrow_udf("array<string>")
    def decode_segment(values: pa.Array) -> pa.Array:
        return decode_batch(values)

    return decode_segment(value)


def decode_with_connector(value: Column) -> Column:
    """The same with Spark's Avro connector, which has to be on the class path."""
    from pyspark.sql.avro import functions as connector

    return connector.from_avro(value, SEGMENT_SCHEMA, {"mode": "PERMISSIVE"})["list"]
