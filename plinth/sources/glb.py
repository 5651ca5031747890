"""Mesh ingest: triangles of binary glTF files as a distributed job over ``binaryFile`` rows."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.operators.meshes import COORDS

# Fixed values of the file format: magic, chunk kinds, component types, components per element.
MAGIC, JSON_CHUNK, BIN_CHUNK = 0x46546C67, 0x4E4F534A, 0x004E4942
DTYPES = {5120: "<i1", 5121: "<u1", 5122: "<i2", 5123: "<u2", 5125: "<u4", 5126: "<f4"}
WIDTHS = {"SCALAR": 1, "VEC2": 2, "VEC3": 3, "VEC4": 4}
POSED_NODE = "placement"
PIECE = 16_384  # triangles that leave a task at once
TRIANGLE_ROWS = pa.schema([("path", pa.string()), ("tri_id", pa.int64()), *((c, pa.float64()) for c in COORDS), ("error", pa.string())])
ROOT = "struct<name:string,translation:array<double>,rotation:array<double>,scale:array<double>>"


def _chunks(content: bytes) -> tuple[dict, bytes]:
    head = np.frombuffer(content[:12], "<u4") if len(content) >= 12 else []
    if not len(head) or head[0] != MAGIC:
        raise ValueError("not a GLB file")
    parts, at = {}, 12
    while at + 8 <= int(head[2]):
        length, kind = np.frombuffer(content[at:at + 8], "<u4")
        parts[int(kind)] = content[at + 8:at + 8 + int(length)]
        at += 8 + int(length)
    if JSON_CHUNK not in parts:
        raise ValueError("no JSON chunk")
    return json.loads(parts[JSON_CHUNK]), parts.get(BIN_CHUNK, b"")


def _accessor(doc: dict, data: bytes, index: int) -> np.ndarray:
    accessor = doc["accessors"][index]
    if "sparse" in accessor or "bufferView" not in accessor:
        raise ValueError("sparse or unbacked accessor")
    view, width = doc["bufferViews"][accessor["bufferView"]], WIDTHS[accessor["type"]]
    dtype = np.dtype(DTYPES[accessor["componentType"]])
    start = view.get("byteOffset", 0) + accessor.get("byteOffset", 0)
    stride = view.get("byteStride", width * dtype.itemsize)
    shape, strides = (accessor["count"], width), (stride, dtype.itemsize)
    return np.ndarray(shape, dtype, data, start, strides).astype("f8")


def _matrix(node: dict) -> np.ndarray:
    if "matrix" in node:
        return np.array(node["matrix"], "f8").reshape(4, 4).T
    x, y, z, w = node.get("rotation", [0, 0, 0, 1])
    turn = np.array([
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ])
    out = np.eye(4)
    out[:3, :3] = turn * np.array(node.get("scale", [1, 1, 1]))
    out[:3, 3] = node.get("translation", [0, 0, 0])
    return out


def scene_triangles(content: bytes) -> np.ndarray:
    """Default-scene triangles as an (n, 9) array in the file's own frame."""
    doc, data = _chunks(content)
    scenes = doc.get("scenes", [])
    if doc.get("scene", 0) >= len(scenes):
        raise ValueError("no scene")
    found, todo = [], [(n, np.eye(4)) for n in reversed(scenes[doc.get("scene", 0)].get("nodes", []))]
    while todo:
        index, parent = todo.pop()
        node = doc["nodes"][index]
        world = parent @ _matrix(node)
        for primitive in doc["meshes"][node["mesh"]]["primitives"] if "mesh" in node else []:
            if primitive.get("mode", 4) != 4:
                continue
            if "KHR_draco_mesh_compression" in primitive.get("extensions", {}):
                raise ValueError("Draco-compressed mesh")
            if "POSITION" not in primitive.get("attributes", {}):
                continue
            points = _accessor(doc, data, primitive["attributes"]["POSITION"])
            if "indices" in primitive:
                points = points[_accessor(doc, data, primitive["indices"]).astype(int).ravel()]
            moved = points[: len(points) // 3 * 3] @ world[:3, :3].T + world[:3, 3]
            found.append(moved.reshape(-1, 9))
        todo += [(child, world) for child in reversed(node.get("children", []))]
    if not sum(len(f) for f in found):
        raise ValueError("no triangles")
    return np.concatenate(found)


def _triangle_rows(paths: list[str], found: list[np.ndarray]) -> pd.DataFrame:
    sizes = [len(f) for f in found]
    rows = pd.DataFrame(np.concatenate(found), columns=COORDS)
    ids = np.concatenate([np.arange(n) for n in sizes])
    return rows.assign(path=np.repeat(np.array(paths, dtype=object), sizes), tri_id=ids, error=None)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files are taken out of a batch one by one, and rows go out in pieces, so neither a batch of files nor all of its
    triangles are Python objects at once.
    """
    columns = ["path", "tri_id", *COORDS, "error"]
    pack = lambda rows: pa.RecordBatch.from_pandas(rows.reindex(columns=columns), TRIANGLE_ROWS, preserve_index=False)
    for batch in batches:
        paths, found, failed, held = [], [], [], 0
        for path, content in zip(*batch.columns):
            try:
                rows = scene_triangles(content.as_py())
                paths.append(path.as_py())
                found.append(rows)
                held += len(rows)
            except (ValueError, KeyError, IndexError, TypeError) as failure:
                failed.append({"path": path.as_py(), "error": str(failure)})
            if held >= PIECE:
                yield pack(_triangle_rows(paths, found))
                paths, found, held = [], [], 0
        if found:
            yield pack(_triangle_rows(paths, found))
        if failed:
            yield pack(pd.DataFrame(failed))


def mesh_rows(files: DataFrame) -> DataFrame:
    """Triangles and read errors of ``files(path, content)`` in one pass; errors never fail the job."""
    schema = "path string, tri_id long, " + ", ".join(f"{c} double" for c in COORDS) + ", error string"
    return files.select("path", "content").mapInArrow(_read, schema)


def triangles(rows: DataFrame) -> DataFrame:
    return rows.where("error is null").drop("error")


def errors(rows: DataFrame) -> DataFrame:
    return rows.where("error is not null").select("path", F.col("error").alias("reason"))


def mesh_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.glb").option(
        "recursiveFileLookup", "true"
    ).load(path)


def scene_roots(files: DataFrame) -> DataFrame:
    """Root nodes of each file's default scene, from its JSON header alone; null where there is none to read.

    The header is the first chunk: its length stands in bytes 13 to 16, its text begins at byte 21. Built-ins read it, so
    no mesh data leaves the JVM.
    """
    hexed = lambda at: F.hex(F.substring("content", at, 4))
    size = F.conv(F.concat(*[F.substring(hexed(13), i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("int")
    valid = (hexed(1) == "676C5446") & (hexed(17) == "4A534F4E")
    header = F.when(valid, F.col("content").substr(F.lit(21), size).cast("string"))
    doc = F.from_json(header, f"scene int, scenes array<struct<nodes:array<int>>>, nodes array<{ROOT}>")
    rows = files.select("path", doc.alias("doc"))
    ids = F.get("doc.scenes", F.coalesce("doc.scene", F.lit(0)))["nodes"]
    roots = F.transform(ids, lambda i: F.get("doc.nodes", i))
    return rows.select("path", F.when(~F.exists(roots, lambda r: r.isNull()), roots).alias("roots"))


def posed(roots: DataFrame) -> DataFrame:
    """Whether a file already carries a pose, and that pose with defaults filled in."""
    root = F.get("roots", 0)
    flag = F.coalesce((F.size("roots") == 1) & (root["name"] == POSED_NODE), F.lit(False))
    default = {"translation": [0.0, 0.0, 0.0], "rotation": [0.0, 0.0, 0.0, 1.0], "scale": [1.0, 1.0, 1.0]}
    values = [
        F.when(flag, F.coalesce(root[name], F.array(*[F.lit(v) for v in value]))).alias(
            "position" if name == "translation" else name
        )
        for name, value in default.items()
    ]
    return roots.select("path", flag.alias("posed"), *values)
