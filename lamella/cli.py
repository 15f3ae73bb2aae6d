"""Command line: ingest, validate, report, split, release, preprocess, scan."""

from __future__ import annotations

import argparse
import json
import sys
import tomllib
from dataclasses import dataclass
from pathlib import Path

from lamella import __version__


@dataclass(frozen=True)
class Config:
    raw_root: Path
    output_root: Path
    task_groups: tuple[str, ...] = ("fungi", "oomycetes")


def load_config(path: str) -> Config:
    """A TOML file; relative paths count from it. The raw root must exist and hold an inventory, the output lies outside it."""
    where = Path(path).resolve()
    values = tomllib.loads(where.read_text(encoding="utf-8"))
    if not {"raw_root", "output_root"} <= values.keys():
        raise ValueError("raw_root and output_root are needed")
    raw, out = ((where.parent / values[k]).resolve() for k in ("raw_root", "output_root"))
    if not (raw / "image_inventory.csv").is_file():
        raise ValueError(f"no inventory in {raw}")
    if out.is_relative_to(raw):
        raise ValueError("the output must lie outside the raw root")
    return Config(raw, out, tuple(values.get("task_groups", Config.task_groups)))


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="lamella", description=__doc__)
    root.add_argument("--version", action="version", version=f"lamella {__version__}")
    verbs = root.add_subparsers(dest="verb", required=True)

    def verb(name: str, *arguments: str) -> None:
        """A verb and what it needs."""
        command = verbs.add_parser(name)
        for argument in arguments:
            command.add_argument(argument, required=True)

    verb("ingest", "--config", "--output")
    verb("validate", "--config", "--catalog")
    verb("report", "--catalog")
    verb("split", "--catalog", "--eligible", "--output")
    verbs.choices["split"].add_argument("--seed", type=int, default=42)
    verbs.choices["split"].add_argument("--policies", help="JSON lines of source_id, license, attribution, expected_images, required_image_role")
    verb("release", "--catalog", "--reviews", "--assignments", "--output", "--release-version")
    verb("preprocess", "--image", "--output")
    verbs.choices["preprocess"].add_argument("--image-size", type=int, default=224)
    verb("scan", "--root")
    return root


def run(args: argparse.Namespace) -> dict | list:
    from lamella.plans import pipelines
    from lamella.session import local_session

    if args.verb == "report":
        return json.loads((Path(args.catalog) / "catalog.json").read_text(encoding="utf-8"))["summary"]
    spark = local_session()
    if args.verb == "ingest":
        return pipelines.ingest(spark, str(load_config(args.config).raw_root), args.output)
    if args.verb == "validate":
        return {"valid": pipelines.validate_catalog(spark, args.catalog, str(load_config(args.config).raw_root))["id"]}
    if args.verb == "split":
        shape = "source_id string, license string, attribution string, expected_images bigint, required_image_role string"
        policies = spark.read.schema(shape).json(args.policies) if args.policies else None
        return pipelines.build_split(spark, args.catalog, spark.read.schema("image_id string").json(args.eligible), args.output, args.seed, policies)
    if args.verb == "release":
        return pipelines.build_release(spark, args.catalog, args.reviews, args.assignments, args.output, args.release_version)
    if args.verb == "scan":
        from lamella.sources.publication import findings

        # Findings go out as they come, one JSON line each; their total follows.
        total = 0
        for r in findings(spark, args.root).toLocalIterator():
            print(json.dumps(r.asDict(), ensure_ascii=False))
            total += 1
        return {"findings": total}
    import hashlib

    from lamella.sources import rasters, sinks

    config = rasters.TensorConfig(args.image_size)
    image = rasters.read_images(spark, args.image).select("image.*").filter("height > 0").first()
    if image is None or rasters.frame_count(Path(args.image).read_bytes()) != 1:
        raise ValueError("no single image there that can be decoded")
    tensor = rasters.to_tensor(rasters.rgb_array(image["data"], image["height"], image["width"], image["nChannels"]), config)
    metadata = {"source_sha256": hashlib.sha256(Path(args.image).read_bytes()).hexdigest(), "shape": list(tensor.shape), "dtype": str(tensor.dtype), "preprocessing": config.description()}
    sinks.write_tensor(args.output, tensor, metadata)
    return metadata


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        print(json.dumps(run(args), indent=2, ensure_ascii=False, default=str))
        return 0
    except (OSError, ValueError, KeyError) as error:
        print(f"lamella: {error}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    raise SystemExit(main())
