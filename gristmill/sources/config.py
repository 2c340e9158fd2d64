"""Dataset configurations and the choice of their files. All of this runs on the driver."""

from __future__ import annotations

import json
import math
import warnings
from dataclasses import dataclass, field
from pathlib import Path


@dataclass
class Dataset:
    """One configuration file."""

    name: str
    enabled: bool
    adapter: str
    sources: list[dict]
    executor: dict = field(default_factory=dict)
    postprocess: dict = field(default_factory=dict)
    path: str = ""

    @staticmethod
    def of(cfg: dict) -> Dataset:
        own = cfg.get("dataset") or {}
        enabled = cfg["enabled"] if "enabled" in cfg else own.get("enabled", True)
        executor = cfg.get("executor") or {}
        if "tasks" in executor:
            warnings.warn("executor.tasks has no effect: Spark splits the input", stacklevel=2)
        path = cfg.get("_config_path", "")
        return Dataset(own.get("name") or Path(path).stem, enabled is True, (cfg.get("adapter") or {}).get("kind", ""), cfg.get("sources") or [], executor, cfg.get("postprocess") or {}, path)

    @property
    def token_budget(self) -> int:
        """Words of budget; 0 is none."""
        try:
            return max(0, int(float(self.executor.get("token_billions") or 0) * 1e9))
        except (TypeError, ValueError):
            return 0

    @property
    def chars_per_token(self) -> float:
        try:
            return float(self.executor.get("chars_per_token") or 4.0)
        except (TypeError, ValueError):
            return 4.0

    @property
    def shard_mb(self) -> float:
        return float(next((self.executor[k] for k in ("target_shard_mb", "target_mb") if self.executor.get(k) is not None), 2))

    @property
    def merge_to_files(self) -> int:
        return int(next((self.executor[k] for k in ("merge_to_files", "merge_outputs_to_files") if self.executor.get(k)), 0))

    @property
    def steps(self) -> list[dict]:
        """The post-processing steps as dicts with a kind: from a list of names or dicts, or one kind."""
        kinds = self.postprocess.get("kinds") or self.postprocess.get("kind") or []
        kinds = kinds if isinstance(kinds, list) else [kinds]
        rest = {k: v for k, v in self.postprocess.items() if k not in ("kinds", "kind")}
        return [rest | (k if isinstance(k, dict) else {"kind": k}) for k in kinds]


def load_configs(config_dir: str) -> list[Dataset]:
    """All *.json files of a folder by name; a malformed one raises."""
    found = []
    for p in sorted(Path(config_dir).glob("*.json")):
        found.append(Dataset.of(json.loads(p.read_text(encoding="utf-8")) | {"_config_path": str(p)}))
    return found


def _globs(source: dict) -> list[str]:
    many = source.get("globs")
    single = (source.get("glob") or "").strip()
    return [single] if single else [g.strip() for g in map(str, many if isinstance(many, list) else []) if g.strip()]


def pick_source(dataset: Dataset, root: str) -> dict | None:
    """The first source whose folder exists and has a matching file; None to skip the dataset."""
    for s in dataset.sources:
        kind, folder, globs = (s.get("type") or "").strip(), (s.get("data_dir") or "").strip(), _globs(s)
        if kind and folder and globs and (base := Path(root) / folder).exists() and any(next(base.glob(g), None) for g in globs):
            return s
    return None


def keywords(source: dict) -> list[str]:
    """path_keywords, include_keywords or path_keyword: distinct, in order."""
    for key in ("path_keywords", "include_keywords", "path_keyword"):
        if value := source.get(key):
            return list(dict.fromkeys(k for k in map(str, value if isinstance(value, list) else [value]) if k.strip()))
    return []


def is_lfs_pointer(path: Path) -> bool:
    """A stand-in for a file that Git LFS hasn't fetched."""
    with path.open("rb") as f:
        return f.read(64).lstrip().startswith(b"version https://git-lfs")


def source_files(source: dict, root: str) -> list[str]:
    """The files of a source: the distinct union of its globs, by name, with any keyword in the relative path."""
    base = Path(root) / source["data_dir"].strip()
    patterns = [p for g in _globs(source) for p in ([g] if "**" in g or not source.get("recursive", True) else [g])]
    found = sorted({p.relative_to(base).as_posix() for g in patterns for p in base.glob(g) if p.is_file()})
    words = keywords(source)
    if words:
        found = [p for p in found if any(w in p for w in words)]
    fetched = []
    for p in found:
        if source.get("type") in ("jsonl", "json_array") and is_lfs_pointer(base / p):
            warnings.warn(f"{p} is a Git LFS pointer and is skipped", stacklevel=2)
            continue
        fetched.append(str(base / p))
    return fetched


def file_stats(files: list[str]) -> tuple[int, int]:
    """Number and bytes of files."""
    return len(files), sum(Path(f).stat().st_size for f in files)


def sample_probability(budget: int, total_bytes: int, chars_per_token: float = 4.0) -> float:
    """L3: the share of rows to keep for a budget of tokens; 1 without one."""
    if budget <= 0:
        return 1.0
    return min(1.0, budget / max(1.0, total_bytes / max(chars_per_token, 1e-6)))


def shard_count(total_bytes: int, shard_mb: float) -> int:
    """Output files of about shard_mb each; 0 leaves the number to Spark."""
    return max(1, math.ceil(total_bytes / (shard_mb * 1e6))) if shard_mb > 0 else 0
