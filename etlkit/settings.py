"""Settings read from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


def _from_env(cls, prefix: str, env: Mapping[str, str] | None):
    env = os.environ if env is None else env
    found = {f.name: env[prefix + f.name.upper()] for f in fields(cls)
             if env.get(prefix + f.name.upper())}
    return cls(**found)


@dataclass(frozen=True)
class SparkSettings:
    """Session settings; ``SPARK_<FIELD>`` overrides a field. ``None`` leaves it to Spark."""

    app_name: str = "etlkit"
    master: str | None = None
    sql_warehouse_dir: str | None = None
    driver_memory: str | None = None
    executor_memory: str | None = None
    executor_cores: str | None = None
    sql_shuffle_partitions: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> "SparkSettings":
        return _from_env(cls, "SPARK_", env)

    def as_conf(self) -> dict[str, str]:
        named = {
            "spark.app.name": self.app_name,
            "spark.master": self.master,
            "spark.sql.warehouse.dir": self.sql_warehouse_dir,
            "spark.driver.memory": self.driver_memory,
            "spark.executor.memory": self.executor_memory,
            "spark.executor.cores": self.executor_cores,
            "spark.sql.shuffle.partitions": self.sql_shuffle_partitions,
        }
        return {key: value for key, value in named.items() if value is not None}


@dataclass(frozen=True)
class WarehouseSettings:
    """Where unqualified table names live; ``WAREHOUSE_<FIELD>`` overrides a field."""

    format: str = "table"
    project: str = ""
    dataset: str = ""
    base_path: str = ""
    parent_project: str = ""
    temp_bucket: str = ""

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> "WarehouseSettings":
        return _from_env(cls, "WAREHOUSE_", env)

    def require_names(self) -> "WarehouseSettings":
        """Fail early when a remote warehouse has no project or dataset to resolve names in."""
        missing = [n for n in ("project", "dataset") if not getattr(self, n)]
        if missing:
            raise ValueError(f"warehouse settings missing: {', '.join(missing)}")
        return self
