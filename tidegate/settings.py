"""Settings of the command line: from the environment, or from a file of NAME=value lines that it overrides."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from tidegate.operators.pipeline import CONFIG

PREFIX = "TIDEGATE_"


class BadSettings(ValueError):
    """A setting is missing or cannot be read."""


def read_file(path: str) -> dict[str, str]:
    """Pairs of a settings file; blank lines and lines that begin with # are skipped, quotes around a value go."""
    out = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                name, eq, value = line.strip().partition("=")
                if eq and not name.startswith("#"):
                    out[name.removeprefix("export ").strip()] = value.strip().strip("\"'")
    return out


@dataclass(frozen=True)
class Settings:
    store: str
    #: A folder of Parquet tables named after the entities, or a JDBC URL.
    source: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = ""
    webhook: str = field(default="", repr=False)
    alert_folder: str = "alerts"
    report_folder: str = "reports"
    buckets: int = 32
    partitions: int = 8
    config: dict[str, str] = field(default_factory=dict)

    @classmethod
    def read(cls, environment: Mapping[str, str] | None = None, file: str = ".env") -> Settings:
        values = read_file(file) | dict(os.environ if environment is None else environment)

        def get(name: str, default: str | None = None) -> str:
            value = values.get(PREFIX + name, "").strip() or default
            if value is None:
                raise BadSettings(f"{PREFIX}{name} is not set")
            return value

        def number(name: str, default: int) -> int:
            text = get(name, str(default))
            if not text.isdigit() or not int(text):
                raise BadSettings(f"{PREFIX}{name} is {text!r}, not a positive number")
            return int(text)

        source = get("SOURCE")
        jdbc = source.startswith("jdbc:")
        tuned = {k: values[n] for k in CONFIG if (n := PREFIX + k.upper().replace(".", "_")) in values}
        return cls(
            get("STORE"), source, get("SOURCE_USER") if jdbc else "", get("SOURCE_PASSWORD") if jdbc else "", get("SOURCE_DRIVER", ""), get("ALERT_WEBHOOK", ""),
            get("ALERT_FOLDER", "alerts"), get("REPORT_FOLDER", "reports"), number("BUCKETS", 32), number("SOURCE_PARTITIONS", 8), tuned,
        )
