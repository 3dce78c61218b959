"""Command line: python -m sieveworks prompts ... | images STAGE ..."""

from __future__ import annotations

import argparse
import dataclasses
from pathlib import Path

from sieveworks.plans import generate, images
from sieveworks.session import session
from sieveworks.sources import config

# The sizes of full and pilot runs.
FULL, PILOT = {"count": 100_000, "shards": 100}, {"count": 1_000, "shards": 1}
IMAGE_PILOT = {"target_count": 1, "shard_size": 1}
OUTPUT, PILOT_OUTPUT = "output/full", "output/pilot"


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="sieveworks", description=__doc__)
    kinds = out.add_subparsers(dest="kind", required=True)
    p = kinds.add_parser("prompts", help="generate prompts")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--count", type=int)
    p.add_argument("--shards", type=int)
    p.add_argument("--output-dir", default=OUTPUT)
    p.add_argument("--pilot", action="store_true")
    p.add_argument("--config-dir", required=True)
    i = kinds.add_parser("images", help="plan, generate, package, validate or run")
    i.add_argument("stage", choices=("plan", "generate", "package", "validate", "run"))
    i.add_argument("--config")
    i.add_argument("--pilot", action="store_true")
    i.add_argument("--output-path")
    i.add_argument("--checkpoint-path")
    i.add_argument("--prompts-path")
    return out


def prompt_sizes(args) -> tuple[int, int, str]:
    """Explicit numbers beat the pilot's; the folder changes only if it is the default."""
    preset = PILOT if args.pilot else FULL
    folder = PILOT_OUTPUT if args.pilot and args.output_dir == OUTPUT else args.output_dir
    return preset["count"] if args.count is None else args.count, preset["shards"] if args.shards is None else args.shards, folder


def image_config(args) -> config.RunConfig:
    """The file, then the pilot, then the output path, then the other paths."""
    c = config.RunConfig.load(args.config)
    if args.pilot:
        c = dataclasses.replace(c, **IMAGE_PILOT)
    if args.output_path:
        c = dataclasses.replace(c, workspace_dir=f"{args.output_path}/workspace", shards_dir=f"{args.output_path}/shards", report_dir=args.output_path)
    if args.checkpoint_path:
        c = dataclasses.replace(c, checkpoint_path=args.checkpoint_path)
    if args.prompts_path:
        c = dataclasses.replace(c, prompts_path=args.prompts_path)
    return c


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    if args.kind == "prompts":
        count, n_shards, folder = prompt_sizes(args)
        vocabulary, negatives = config.load_vocabulary(args.config_dir), config.load_negatives(args.config_dir)
        Path(folder).mkdir(parents=True, exist_ok=True)
        run = generate.generate(spark, vocabulary, negatives, args.seed, count, n_shards)
        generate.publish(run, folder, args.seed, count, [vocabulary, negatives], lambda name, text: (Path(folder) / name).write_text(text))
        return 0
    getattr(images, args.stage)(spark, image_config(args))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
