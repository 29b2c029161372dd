"""Paths of the lake and of the stream checkpoints: T9."""

from __future__ import annotations

import os
from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """All table locations below one root, all checkpoints below another."""

    root: str
    checkpoint_root: str | None = None

    @classmethod
    def from_environment(
        cls, root: str | None = None, checkpoint_root: str | None = None
    ) -> Lake:
        """Explicit values first, then ``LAKE_ROOT`` and the checkpoint root."""
        root = root or os.getenv("LAKE_ROOT")
        if not root:
            raise ValueError("a lake root is required (argument or LAKE_ROOT)")
        return cls(root, checkpoint_root or os.getenv("STREAMING_CHECKPOINT_ROOT"))

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def checkpoint(self, query: str) -> str:
        """Checkpoint of one streaming query; every query has its own."""
        base = self.checkpoint_root or self._at("checkpoints")
        return f"{base.rstrip('/')}/{query}"

    # Directory names of the layers.
    @property
    def bronze(self) -> str:
        return self._at("bronze", "raw_inventory_events")

    @property
    def failed_records(self) -> str:
        return self._at("bronze", "failed_producer_events")

    @property
    def silver_movements(self) -> str:
        return self._at("silver", "inventory_movements")

    @property
    def silver_invalid(self) -> str:
        return self._at("silver", "inventory_alerts")

    @property
    def velocity(self) -> str:
        return self._at("silver", "sales_velocity_5m")

    @property
    def state_history(self) -> str:
        return self._at("silver", "current_inventory_state_history")

    @property
    def packed_history(self) -> str:
        return self._at("silver", "packed_inventory_state_history")

    @property
    def late_sales(self) -> str:
        return self._at("silver", "late_sales")

    @property
    def snapshots(self) -> str:
        return self._at("snapshots", "inventory_snapshot")

    @property
    def gold_reconciliation(self) -> str:
        return self._at("gold", "inventory_reconciliation")

    @property
    def gold_daily_summary(self) -> str:
        return self._at("gold", "daily_inventory_summary")

    @property
    def accepted(self) -> str:
        return self._at("state", "processed_events")

    @property
    def consumed_ids(self) -> str:
        return self._at("state", "consumed_ids")

    @property
    def alerts(self) -> str:
        return self._at("state", "alerts")

    @property
    def inventory(self) -> str:
        return self._at("state", "current_inventory")

    @property
    def promotions(self) -> str:
        return self._at("state", "promotion_metrics")

    @property
    def velocity_scopes(self) -> str:
        return self._at("state", "sales_velocity_5m")

    @property
    def finished_batches(self) -> str:
        return self._at("state", "finished_batches")

    def staging(self, table: str) -> str:
        return self._at("staging", table)

    def mart(self, table: str) -> str:
        return self._at("mart", table)

    @property
    def load_log(self) -> str:
        return self._at("audit", "redshift_load_log")
