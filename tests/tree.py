"""A small acquisition tree written file by file."""

import csv
import hashlib
import json
import struct
import zlib

import numpy as np


def png(rgb: np.ndarray) -> bytes:
    h, w = rgb.shape[:2]
    raw = b"".join(b"\0" + np.ascontiguousarray(row).tobytes() for row in rgb.astype(np.uint8))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def pattern(seed: int, h: int = 24, w: int = 32) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3)).astype(np.uint8)


def write_tree(root) -> list[dict]:
    """Nine images in three collections: a copy across collections, a mirrored one, boxes, a crop and its field."""
    images = {
        "01_tgfc/extracted/main/train/images/a_jpg.rf.0123456789abcdef0123456789abcdef.png": pattern(1),
        "01_tgfc/extracted/main/valid/images/b.png": pattern(2),
        "01_tgfc/extracted/main/test/images/c.png": pattern(2)[:, ::-1],
        "01_tgfc/extracted/MixedClass/d.png": pattern(4),
        "02_idphy_microscopy/images/e.png": pattern(5),
        "02_idphy_microscopy/images/f.png": pattern(1),
        "02_idphy_microscopy/images/g.png": pattern(7),
        "03_soil_fungi_phytophthora/images/Fusarium_12.png": pattern(8),
        "03_soil_fungi_phytophthora/images/Fusarium_12_crop1.png": pattern(9),
    }
    rows = []
    for path, rgb in images.items():
        content = png(rgb)
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
        rows.append({"collection": path.split("/")[0], "path": path, "bytes": len(content), "sha256": hashlib.sha256(content).hexdigest(), "width": 32, "height": 24, "format": "PNG"})
    with (root / "image_inventory.csv").open("w", newline="") as f:
        writer = csv.DictWriter(f, fieldnames=list(rows[0]))
        writer.writeheader()
        writer.writerows(reversed(rows))
    for split, stem, text in (("train", "a_jpg.rf.0123456789abcdef0123456789abcdef", "0 0.5 0.5 0.25 0.25\n\n1 0.1 0.2 0.1 0.1\n"), ("valid", "b", "0 0.5 0.5 1 1\n"), ("test", "c", "")):
        folder = root / f"01_tgfc/extracted/main/{split}/labels"
        folder.mkdir(parents=True)
        (folder / f"{stem}.txt").write_text(text)
    (root / "01_tgfc/extracted/main/data.yaml").write_text("nc: 2\nnames:\n  - Colletotrichum siamense\n  - Olivea tectonae\n")
    by_name = {r["path"].split("/")[-1]: r for r in rows}
    download = lambda name, **more: {"filename": name, "bytes": by_name[name]["bytes"], "sha256": by_name[name]["sha256"], "source_url": f"https://example.org/{name}", **more}
    gallery = lambda labels, caption: {"species_labels": labels, "caption": caption, "gallery_records": [{"caption": "second view of CBS 1234"}]}
    manifests = {
        "01_tgfc": [],
        "02_idphy_microscopy": [
            download("e.png", source_metadata=gallery(["Phytophthora ramorum"], "isolate PH168")),
            download("f.png", source_metadata=gallery(["Phytophthora sp."], "no code")),
            download("g.png", source_metadata=gallery(["Phytophthora cinnamomi (in progress)"], "P168, tester")),
        ],
        "03_soil_fungi_phytophthora": [
            download("Fusarium_12.png", source_label="Fusarium", parent_image_id="Fusarium_12", image_role="full_field"),
            download("Fusarium_12_crop1.png", source_label="Fusarium", parent_image_id="Fusarium_12", image_role="crop"),
        ],
    }
    for collection, items in manifests.items():
        (root / collection / "metadata").mkdir(parents=True)
        (root / collection / "download_manifest.json").write_text(json.dumps({"source_url": "https://example.org", "version": 1, "license": {"name": "CC BY"}, "downloads": items, "errors": [], "expected_files": len(items)}))
        name = "selection_manifest" if collection.startswith("02") else "repository_record"
        (root / collection / "metadata" / f"{name}.json").write_text(json.dumps({"title": collection}))
    return rows
