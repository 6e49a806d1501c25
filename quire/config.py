"""Settings and the artifact tree."""

from __future__ import annotations

import os
import shutil
import subprocess
from dataclasses import dataclass, fields
from datetime import datetime, timezone

FALSE = ("0", "false", "no", "off")


def env_flag(name: str, default: bool = False, env=os.environ) -> bool:
    value = env.get(name)
    return default if value is None else value.strip().lower() not in FALSE


def dotenv(path: str) -> dict[str, str]:
    """KEY=VALUE lines of a file; a missing file has none."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        lines = [x.strip() for x in f]
    pairs = (x.partition("=") for x in lines if x and not x.startswith("#") and "=" in x)
    return {k.strip(): v.strip().strip('"').strip("'") for k, _, v in pairs}


@dataclass(frozen=True)
class Config:
    teacher_model: str = "gemma-4-31b-it"
    min_confidence: float = 0.6
    max_page_attempts: int = 3
    min_request_interval: float = 3.2
    concurrency: int = 4
    quota_stop_count: int = 3
    quota_backoff: float = 65.0
    quota_cooldown: float = 0.0
    short_quota_limit: int = 100
    visual_tokens: int = 1120

    @classmethod
    def read(cls, env) -> Config:
        """From variables named as the fields, in capitals."""
        return cls(**{f.name: type(f.default)(env[f.name.upper()]) for f in fields(cls) if f.name.upper() in env})


@dataclass(frozen=True)
class Layout:
    """Where each kind of dataset lies below the output root."""

    root: str

    FOLDERS = ("manifests", "renders", "splits", "text", "gold", "exports", "reports", "calibration", "evaluation", "logs")

    def path(self, folder: str, name: str = "") -> str:
        if folder not in self.FOLDERS:
            raise KeyError(folder)
        return "/".join(x for x in (self.root.rstrip("/"), folder, name) if x)

    def make(self) -> None:
        for f in self.FOLDERS:
            os.makedirs(self.path(f), exist_ok=True)


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def run_cmd(args: list[str], timeout: float = 120) -> subprocess.CompletedProcess:
    return subprocess.run(args, capture_output=True, text=True, timeout=timeout, check=False)


def ensure_tools(names: tuple[str, ...] = ("file", "pdfinfo", "pdftoppm", "pdftotext")) -> None:
    missing = [n for n in names if not shutil.which(n)]
    if missing:
        raise RuntimeError(f"missing tools: {', '.join(missing)}")
