"""Graphs of array operations for onnxruntime, which runs small products, softmax and gathers of
many rows in a fraction of numpy's time.  Its model format is written here by hand: a message is
a row of fields, each a tag and a number or a length and bytes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

FLOAT, INT64 = 1, 7
OPSET, IR_VERSION = 18, 8


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def field(number: int, value: int | str | bytes) -> bytes:
    if isinstance(value, int):
        return varint(number << 3) + varint(value & (1 << 64) - 1)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def node(kind: str, inputs: str, output: str, domain: str = "", **attributes: int | str) -> bytes:
    """One operation; inputs are names with blanks between."""
    parts = [field(1, name) for name in inputs.split()] + [field(2, output), field(4, kind), field(7, domain)]
    for name, v in attributes.items():
        given = field(3, v) + field(20, 2) if isinstance(v, int) else field(4, v) + field(20, 3)
        parts.append(field(5, field(1, name) + given))
    return field(1, b"".join(parts))


def product(inputs: str, output: str, **attributes: int) -> bytes:
    """Matrix product of each row's matrices; ``transA``, ``transB`` turn one of them."""
    return node("FusedMatMul", inputs, output, "com.microsoft", **attributes)


def constant(name: str, values: list[int]) -> bytes:
    shape = field(1, len(values))
    return field(5, shape + field(2, INT64) + field(8, name) + field(9, np.array(values, "<i8").tobytes()))


def array(number: int, name: str, kind: int, shape: tuple[int | str, ...] | None) -> bytes:
    """An input or output; a text in its shape is a length that calls give."""
    lengths = b"".join(field(1, field(1, d) if isinstance(d, int) else field(2, d)) for d in shape or ())
    return field(number, field(1, name) + field(2, field(1, field(1, kind) + (field(2, lengths) if shape else b""))))


def compiled(
    nodes: list[bytes], constants: dict[str, list[int]], inputs: dict[str, tuple[int, tuple[int | str, ...]]], outputs: list[str]
) -> Callable[[dict[str, np.ndarray]], list[np.ndarray]]:
    """A function from the inputs by name to the outputs, on one thread."""
    import onnxruntime

    graph = b"".join(
        [*nodes, field(2, "graph"), *(constant(*c) for c in constants.items())]
        + [array(11, name, *of) for name, of in inputs.items()]
        + [array(12, name, FLOAT, None) for name in outputs]
    )
    versions = field(8, field(1, "") + field(2, OPSET)) + field(8, field(1, "com.microsoft") + field(2, 1))
    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1
    options.log_severity_level = 3
    session = onnxruntime.InferenceSession(
        field(1, IR_VERSION) + field(7, graph) + versions, options, providers=["CPUExecutionProvider"]
    )
    return lambda given: session.run(outputs, given)
