"""Command line: ``python -m brinewake --deployments ... --positions ... --output ... [--steps ...]``."""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession

from .plans import steps


def parser() -> argparse.ArgumentParser:
    """One option for every field of ``steps.Options``."""
    p = argparse.ArgumentParser(prog="brinewake", description="From raw messages, readings and recordings to a labelled data set.")
    for f in dataclasses.fields(steps.Options):
        name, required = "--" + f.name.replace("_", "-"), f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING
        if f.type == "bool":
            p.add_argument(name, action="store_true")
        elif f.name == "radii":
            p.add_argument(name, type=int, nargs="+", default=list(f.default))
        elif f.name == "least":
            p.add_argument("--least-background", type=int, default=30)
            p.add_argument("--least-vessel", type=int, default=5)
        else:
            kind = int if "int" in f.type else float if f.type == "float" else str
            p.add_argument(name, type=kind, required=required, default=None if required else f.default)
    p.add_argument("--steps", choices=steps.STEPS, default=steps.STEPS[-1], help="the last step to run")
    return p


def options(argv: list[str] | None = None) -> tuple[steps.Options, str]:
    a = vars(parser().parse_args(argv))
    last = a.pop("steps")
    a["least"] = {"background": a.pop("least_background"), "vessel": a.pop("least_vessel")}
    a["radii"] = tuple(a["radii"])
    return steps.Options(**a), last


def main(argv: list[str] | None = None) -> dict[str, str]:
    o, last = options(argv)
    paths = steps.run(SparkSession.builder.getOrCreate(), o, last)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    return paths


if __name__ == "__main__":
    main()
