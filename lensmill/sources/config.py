"""Configurations: scoring, rule packages and lookup tables from YAML or JSON files of any file system Spark knows."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from typing import Any

from pyspark.sql import SparkSession

from lensmill.functions import rules as R
from lensmill.functions.scoring import Scoring

# The sections that a configuration must have, and the source types that may be excluded.
SECTIONS = ("filter", "prefilter", "oracle", "preprocessing", "scoring", "training", "hybrid_inference", "deployment")
SCORING_KEYS = ("dimensions", "gatekeepers", "tiers", "score_scale_factor")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    """One small file, whole."""
    return spark.read.text(path, wholetext=True).first()[0]


def read_config(spark: SparkSession, path: str) -> dict[str, Any]:
    """A YAML (.yaml, .yml) or JSON file whose top level is a mapping."""
    text = read_text(spark, path)
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ModuleNotFoundError as e:
            raise ModuleNotFoundError("YAML configurations need the yaml package; JSON ones do not") from e
        found = yaml.safe_load(text)
    else:
        found = json.loads(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path} is no mapping")
    return found


def problems(config: Mapping[str, Any], known_source_types: Collection[str] = (), weights: bool = True) -> list[str]:
    """What a configuration lacks or has in a wrong form, as ``kind:detail`` in order; [] if it conforms."""
    out = [f"missing_top_level:{s}" for s in SECTIONS if s not in config]
    if "ground_truth" in config:
        out.append("unexpected_top_level:ground_truth")
    scoring = config.get("scoring")
    if isinstance(scoring, dict):
        out += [f"scoring_missing:{k}" for k in SCORING_KEYS if k not in scoring]
        if isinstance(scoring.get("gatekeepers"), list):
            out.append("scoring_type:gatekeepers_is_list_not_dict")
        dims = scoring.get("dimensions")
        if weights and isinstance(dims, dict) and dims:
            total = sum(float((d or {}).get("weight", 0.0)) for d in dims.values())
            if abs(total - 1) > 0.01:
                out.append(f"scoring_weights:{total:.3f}")
    elif "scoring" in config:
        out.append("missing_top_level:scoring" if scoring is None else "scoring_type:not_a_dict")
    return sorted(set(out + _source_filter(config.get("source_filter"), known_source_types)))


def _source_filter(found: Any, known: Collection[str]) -> list[str]:
    if found is None:
        return []
    if not isinstance(found, dict):
        return ["source_filter_type:not_a_dict"]
    out, excluded = [], found.get("excluded_source_types")
    if excluded is None:
        out.append("source_filter_missing:excluded_source_types")
    elif not isinstance(excluded, list):
        out.append("source_filter_type:excluded_not_list")
    else:
        out += ["source_filter_type:excluded_item_not_str" for e in excluded if not isinstance(e, str)]
        out += [f"source_filter_unknown_type:{e}" for e in excluded if isinstance(e, str) and known and e not in known]
    if not isinstance(found.get("shadow_mode", False), bool):
        out.append("source_filter_type:shadow_mode_not_bool")
    return out


def dimensions(config: Mapping[str, Any]) -> list[str]:
    """Dimension names in the order of the file, which is the order of labels."""
    return list((config.get("scoring") or {}).get("dimensions") or {})


def scoring_of(config: Mapping[str, Any]) -> Scoring | None:
    """How scores become a tier; None without dimensions.

    The gatekeeper is the first entry of ``gatekeepers``, else the first dimension that is marked as one. Tiers with a
    threshold count, in falling order; the last one takes the rest.
    """
    scoring, head = config.get("scoring") or {}, config.get("filter") or {}
    dims = scoring.get("dimensions")
    if not dims:
        return None
    names, gate, low, cap = list(dims), None, 3.0, 3.0
    listed = scoring.get("gatekeepers") or {}
    if listed:
        g = next(iter(listed.values()))
        gate, low, cap = g.get("dimension"), float(g.get("threshold", low)), float(g.get("max_score", cap))
    else:
        for n in names:
            if (dims[n] or {}).get("gatekeeper"):
                gate, low, cap = n, float(dims[n].get("gatekeeper_threshold", 0)), float(dims[n].get("gatekeeper_max_score", 0))
                break
    tiers = [(n, float(t["threshold"] if isinstance(t, dict) else t)) for n, t in (scoring.get("tiers") or {}).items() if isinstance(t, int | float) or (isinstance(t, dict) and "threshold" in t)]
    own = {"tiers": tuple(sorted(tiers, key=lambda t: -t[1]))} if tiers else {}
    version = int(float(str(head.get("version", "0")).lstrip("v") or 0))
    return Scoring(str(head.get("name", "")), version, tuple(float((dims[n] or {}).get("weight", 0.0)) for n in names), names.index(gate) if gate in names else None, low, cap, **own)


def lookup_table(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """A calibration or normalization table; None where the file is missing, so scores pass through."""
    return read_config(spark, path) if exists(spark, path) else None


def _category(c: Mapping[str, Any]) -> R.Category:
    return R.Category(c["name"], tuple(c["patterns"]), tuple(c.get("exceptions", ())), c.get("positive_at"), tuple(c.get("keywords", ())))


def package_of(config: Mapping[str, Any]) -> R.Package:
    """A rule package as data: name, version, domains (substring to reason), categories, positive, keywords, min_length."""
    keywords = tuple(config.get("override_keywords", ()))
    domains = tuple((d, r) for d, r in (config.get("domains") or {}).items())
    return R.Package(
        str(config["name"]), int(config.get("version", 1)), categories=tuple(map(_category, config.get("categories", ()))), positive=tuple(config.get("positive", ())),
        override=R.Keyword(keywords) if keywords else None, domains=domains, min_length=config.get("min_length", 300), validate=bool(config.get("validate", True)),
    )


def load_package(spark: SparkSession, path: str) -> R.Package:
    return package_of(read_config(spark, path))


def analysis_field(package: str) -> str:
    """The column that an oracle's answer for a package goes to."""
    return f"{package}_analysis"


def checklist(config: Mapping[str, Any], directory_version: int | None = None, samples: int | None = None, least: int = 0, known_source_types: Sequence[str] = ()) -> list[str]:
    """What stands between a package and its use: schema, scoring, version and rows."""
    s = scoring_of(config)
    out = problems(config, known_source_types) + (s.problems() if s else ["no dimensions"])
    if directory_version is not None and s and s.version != directory_version:
        out.append(f"version {s.version} in the directory of version {directory_version}")
    if samples is not None and samples < least:
        out.append(f"{samples} training rows, {least} wanted")
    return out
