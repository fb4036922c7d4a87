"""Some rows of a record batch, fetched by the byte ranges of its buffers.

pyarrow fetches a batch as a whole. For a file on an object store that is one batch of many gigabytes, each task
instead fetches the batch's description, lays it over an image of the batch that holds nothing else yet, and fills in the bytes of
its own rows. The image is memory that the system provides when it is first touched, so a task holds what it
has fetched.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import ipc

# Fixed values of the file format: the length of its opening mark, and what a message begins with.
_MARK = 8
_MESSAGE = struct.Struct("<iI")
_CONTINUES = -1

_HEAD = 1 << 16


class RangedBatches:
    """The record batches of an uncompressed file, of which ranges of rows can be fetched."""

    def __init__(self, file: pa.NativeFile, schema: pa.Schema, columns: list[str], described: list[tuple[int, bytes]]):
        self._file, self._schema, self._columns = file, schema, columns
        self._described = described

    @classmethod
    def of(cls, file: pa.NativeFile, schema: pa.Schema, columns: list[str], batches: int) -> RangedBatches | None:
        """None if ``columns`` cannot be fetched by ranges: compressed, or of a type without ranges of rows. All
        tasks that ask find the same."""
        if not all(_rangeable(schema.field(name).type) for name in columns):
            return None
        if any(pa.types.is_dictionary(f.type) for f in schema):
            return None
        found = cls(file, schema, columns, [])
        for place, head, kind in _messages(file):
            if kind == "record batch":
                found._described.append((place, head))
            elif kind != "schema":
                return None
        if len(found._described) != batches or not all(found._plain(i) for i in range(batches)):
            return None
        return found

    def rows(self, number: int) -> int:
        return self._laid(number)[1].num_rows

    def fetch(self, number: int, start: int, stop: int) -> pa.RecordBatch:
        """Rows ``start`` to ``stop`` of a batch."""
        image, batch = self._laid(number)
        place = self._described[number][0]

        def fill(buffer: pa.Buffer, low: int, high: int) -> None:
            if low < high:
                at = buffer.address - image.address + low
                self._file.seek(place + at)
                image.memory[at : at + high - low] = self._file.read(high - low)

        for name in self._columns:
            column = batch.column(name)
            _fill(column.type, iter(column.buffers()), start, stop, fill)
        # A copy of these rows alone: around them the image is empty, which is no valid batch.
        return ipc.read_record_batch(batch.slice(start, stop - start).serialize(), batch.schema)

    def _laid(self, number: int) -> tuple[_Image, pa.RecordBatch]:
        place, head = self._described[number]
        image = _Image(self._file.size() - place, head)
        batch = ipc.read_record_batch(ipc.read_message(image.reader()), self._schema)
        return image, batch.select(self._columns)

    def _plain(self, number: int) -> bool:
        """Whether the buffers lie in the file as they are in memory. Of a compressed batch an empty image has none."""
        try:
            image, batch = self._laid(number)
        except (pa.ArrowException, OSError):  # nothing is read here: this is what decompressing nothing raises
            return False
        held = all(image.holds(b) for c in batch.columns for b in c.buffers() if b is not None and b.size)
        return held and all(map(_complete, batch.columns))


class _Image:
    """Memory as large as the rest of a file from some message on, empty but for the message's head."""

    def __init__(self, size: int, head: bytes):
        flags = mmap.MAP_PRIVATE | mmap.MAP_ANONYMOUS | getattr(mmap, "MAP_NORESERVE", 0)
        self.memory = mmap.mmap(-1, size, flags=flags, prot=mmap.PROT_READ | mmap.PROT_WRITE)
        self.memory[: len(head)] = head
        self._buffer = pa.py_buffer(self.memory)
        self.address = self._buffer.address

    def reader(self) -> pa.BufferReader:
        return pa.BufferReader(self._buffer)

    def holds(self, buffer: pa.Buffer) -> bool:
        return self.address <= buffer.address and buffer.address + buffer.size <= self.address + self._buffer.size


def _messages(file: pa.NativeFile) -> Iterator[tuple[int, bytes, str]]:
    """Where each message begins, its head and its kind; bodies are not fetched."""
    place, size = _MARK, file.size()
    while place + _MESSAGE.size <= size:
        file.seek(place)
        head = file.read(min(_HEAD, size - place))
        mark, length = _MESSAGE.unpack_from(head)
        if mark != _CONTINUES:
            yield place, b"", "unknown"  # as versions before 0.15 wrote
            return
        if length == 0:
            return
        length += _MESSAGE.size
        if length > len(head):
            head += file.read(length - len(head))
        message = ipc.read_message(_Image(size - place, head[:length]).reader())
        yield place, head[:length], message.type
        place += length + (message.body.size if message.body is not None else 0)


def _is_varied(kind: pa.DataType) -> bool:
    t = pa.types
    return t.is_string(kind) or t.is_binary(kind) or t.is_large_string(kind) or t.is_large_binary(kind)


def _is_listed(kind: pa.DataType) -> bool:
    return pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_map(kind)


def _width(kind: pa.DataType) -> int:
    """Bits of a value, or of the place where one begins."""
    if _is_varied(kind) or _is_listed(kind):
        large = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind) or pa.types.is_large_list(kind)
        return 64 if large else 32
    return kind.bit_width


def _is_flat(kind: pa.DataType) -> bool:
    t = pa.types
    return t.is_primitive(kind) or t.is_decimal(kind) or t.is_fixed_size_binary(kind)


def _parts(kind: pa.DataType) -> list[pa.DataType]:
    if pa.types.is_map(kind):
        return [pa.struct([kind.key_field, kind.item_field])]
    if pa.types.is_struct(kind):
        return [f.type for f in kind]
    return [kind.value_type] if _is_listed(kind) or pa.types.is_fixed_size_list(kind) else []


def _rangeable(kind: pa.DataType) -> bool:
    nested = _is_listed(kind) or pa.types.is_struct(kind) or pa.types.is_fixed_size_list(kind)
    return _is_flat(kind) or _is_varied(kind) or nested and all(map(_rangeable, _parts(kind)))


def _complete(array: pa.Array) -> bool:
    """Whether the buffers of values, or of places where they begin, are as long as they have to be."""
    kind = array.type
    if pa.types.is_struct(kind):
        return all(_complete(array.field(i)) for i in range(kind.num_fields))
    if pa.types.is_fixed_size_list(kind):
        return _complete(array.values)
    if not len(array):
        return True
    places, buffer = len(array) + (not _is_flat(kind)), array.buffers()[1]
    return buffer is not None and buffer.size >= -(-places * _width(kind) // 8)


def _fill(kind: pa.DataType, buffers: Iterator[pa.Buffer | None], start: int, stop: int, fill) -> None:
    """Fetch what rows ``start`` to ``stop`` need of an array's buffers, which come in the order of the format."""
    present = next(buffers)
    if present is not None:
        fill(present, start // 8, min(-(-stop // 8), present.size))
    if _is_flat(kind):
        fill(next(buffers), start * _width(kind) // 8, -(-stop * _width(kind) // 8))
        return
    if _is_varied(kind) or _is_listed(kind):
        places = next(buffers)
        start, stop = _ends(places, _width(kind) // 8, start, stop, fill)
        if _is_varied(kind):
            fill(next(buffers), start, stop)
            return
    if pa.types.is_fixed_size_list(kind):
        start, stop = start * kind.list_size, stop * kind.list_size
    for part in _parts(kind):
        _fill(part, buffers, start, stop, fill)


def _ends(places: pa.Buffer | None, width: int, start: int, stop: int, fill) -> tuple[int, int]:
    if places is None or start == stop:
        return 0, 0
    fill(places, start * width, (stop + 1) * width)
    view = memoryview(places)
    return tuple(int.from_bytes(view[i * width : (i + 1) * width], "little") for i in (start, stop))
