"""Instruction statistics of compiled programs: ELF text sections as streams of opcodes."""

from __future__ import annotations

import struct
import tarfile
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the instruction set: classes, sizes, operations.
_SIZE = {"W": 0x00, "H": 0x08, "B": 0x10, "DW": 0x18}
_ALU = {"ADD": 0x00, "SUB": 0x10, "MUL": 0x20, "DIV": 0x30, "OR": 0x40, "AND": 0x50, "LSH": 0x60, "RSH": 0x70, "MOD": 0x90, "XOR": 0xA0, "MOV": 0xB0, "ARSH": 0xC0, "SDIV": 0xE0}
_JUMP = {"JEQ": 0x10, "JGT": 0x20, "JGE": 0x30, "JSET": 0x40, "JNE": 0x50, "JSGT": 0x60, "JSGE": 0x70, "JLT": 0xA0, "JLE": 0xB0, "JSLT": 0xC0, "JSLE": 0xD0}
LD_DW_IMM = 0x18


def mnemonics() -> dict[int, str]:
    """Opcode to name, from the rule that composes both: class, mode or operation, and source."""
    out = {LD_DW_IMM: "LD_DW_IMM", 0xC3: "ST_W_XADD", 0xDB: "ST_DW_XADD", 0x84: "NEG32", 0x87: "NEG64", 0xD4: "LE", 0xDC: "BE", 0x05: "JA", 0x85: "CALL_IMM", 0x8D: "CALL_REG", 0x95: "EXIT"}
    for name, size in _SIZE.items():
        out |= {0x20 | size: f"LD_ABS_{name}", 0x40 | size: f"LD_IND_{name}", 0x61 | size: f"LD_{name}_REG", 0x62 | size: f"ST_{name}_IMM", 0x63 | size: f"ST_{name}_REG"}
    for name, op in _ALU.items():
        out |= {op | kind | source: f"{name}{bits}_{how}" for kind, bits in ((4, 32), (7, 64)) for source, how in ((0, "IMM"), (8, "REG"))}
    for name, op in _JUMP.items():
        out |= {op | 5: f"{name}_IMM", op | 13: f"{name}_REG"}
    return out


def text_section(elf: bytes) -> bytes:
    """The .text section of a 64-bit little-endian ELF file."""
    if elf[:4] != b"\x7fELF" or elf[4:6] != b"\x02\x01":
        raise ValueError("not a 64-bit little-endian ELF file")
    at, = struct.unpack_from("<Q", elf, 0x28)
    size, count, names = struct.unpack_from("<HHH", elf, 0x3A)
    heads = [struct.unpack_from("<IIQQQQ", elf, at + k * size) for k in range(count)]
    table = heads[names]
    for name, _, _, _, offset, length in heads:
        start = table[4] + name
        if elf[start : elf.index(b"\0", start)] == b".text":
            return elf[offset : offset + length]
    raise ValueError("no .text section")


def opcodes(text: bytes) -> Iterator[int]:
    """One opcode for each instruction of eight bytes; a wide load takes sixteen."""
    at = 0
    while at + 8 <= len(text):
        yield text[at]
        at += 16 if text[at] == LD_DW_IMM else 8


def instruction_counts(programs: DataFrame) -> DataFrame:
    """(program, opcode, n) of (program, content) rows, counted before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = Counter(opcodes(text_section(content)))
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(n)), pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64())], names=["program", "opcode", "n"])

    return programs.select("program", "content").mapInArrow(run, "program string, opcode int, n long")


def histogram(counts: DataFrame) -> DataFrame:
    """(opcode, mnemonic, num_programs, num_insns) in order of opcode; unknown opcodes are named 'invalid'."""
    names = F.create_map(*[F.lit(x) for item in sorted(mnemonics().items()) for x in item])
    sums = counts.groupBy("opcode").agg(F.count_distinct("program").alias("num_programs"), F.sum("n").alias("num_insns"))
    named = sums.select(F.format_string("0x%02x", "opcode").alias("hex"), F.coalesce(F.try_element_at(names, F.col("opcode")), F.lit("invalid")).alias("mnemonic"), "num_programs", "num_insns", "opcode")
    return named.orderBy("opcode").select(F.col("hex").alias("opcode"), "mnemonic", "num_programs", "num_insns")


def read_programs(spark: SparkSession, path: str) -> DataFrame:
    """(program, content) of a directory of ELF files."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("program"), "content")


def read_program_tar(spark: SparkSession, stream, folder: str, held: int = 64 << 20) -> DataFrame:
    """(program, content) of a tar of ELF files, read from a stream such as standard input. Programs go to `folder` as
    they come, so the driver holds `held` bytes and one program at most."""
    schema, rows, size = "program string, content binary", [], 0

    def put() -> None:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)

    with tarfile.open(fileobj=stream, mode="r|") as tar:
        for member in tar:
            if member.isfile():
                rows.append((member.name, tar.extractfile(member).read()))
                size += len(rows[-1][1])
                if size >= held:
                    put()
                    rows, size = [], 0
    put()
    return spark.read.schema(schema).parquet(folder)


def write_histogram(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
