"""Per-item stage machine (T2-T4, T6): pure transitions, kept by the stateful operator of ``streams``."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass, field

from quaverlake.plans.vocabulary import PARALLEL_STAGES

FIRST, SECOND, LAST = "music_gate", "discogs_mir", "section_asr"


def request_id(job: str, audio: str, stage: str, fingerprint: str) -> str:
    return hashlib.sha256("\x00".join((job, audio, stage, fingerprint)).encode()).hexdigest()


@dataclass
class StageRow:
    status: str
    fingerprint: str
    request: str
    attempt: int = 0
    result: str | None = None
    error: str | None = None


@dataclass
class Item:
    """One track of a job: its status and stages. Refused transitions return a reason and change nothing."""

    job: str
    audio: str
    fingerprint: str | None = None
    status: str = "pending"
    content_type: str | None = None
    stages: dict[str, StageRow] = field(default_factory=dict)

    def register(self, fingerprint: str) -> str | None:
        if self.fingerprint is None:
            self.fingerprint = fingerprint
            return None
        return "duplicate id" if self.fingerprint == fingerprint else "input changed"

    def prepare(self, stage: str, fingerprint: str) -> str | None:
        """Insert the stage's row unless it is there; another input than before is refused."""
        row = self.stages.setdefault(stage, StageRow("pending", fingerprint, request_id(self.job, self.audio, stage, fingerprint)))
        return None if row.fingerprint == fingerprint else "stage input changed"

    def claim(self, stage: str, fingerprint: str) -> str | None:
        """pending -> running, one attempt more."""
        row = self.stages.get(stage)
        if row is None or row.status != "pending" or row.fingerprint != fingerprint:
            return "not pending with this input"
        row.status, row.error = "running", None
        row.attempt += 1
        return None

    def settle(self, stage: str, request: str, result: str | None, error: str | None) -> str | None:
        """running -> succeeded or failed, for the request that runs."""
        row = self.stages.get(stage)
        if row is None or row.status != "running" or row.request != request:
            return "not running this request"
        row.status = "failed" if error is not None else "succeeded"
        row.result, row.error = result, error
        if error is not None:
            self.status = "failed"
        elif stage in (FIRST, SECOND) and result in ("review", "rejected"):
            self.status = result
        elif stage == SECOND:
            self.content_type = result
        return None

    def recover(self) -> int:
        """After a crash running stages are pending again; their requests keep their ids."""
        rows = [r for r in self.stages.values() if r.status == "running"]
        for row in rows:
            row.status = "pending"
        return len(rows)

    def unpublish(self) -> str | None:
        """A published item whose file is gone is to be published again."""
        if self.status != "published":
            return "not published"
        self.status = "pending"
        return None

    def publish(self) -> str | None:
        if self.status != "pending" or not self.complete():
            return "stages are not complete"
        self.status = "published"
        return None

    def done(self, stage: str) -> bool:
        row = self.stages.get(stage)
        return row is not None and row.status == "succeeded"

    def complete(self) -> bool:
        if self.content_type not in ("song", "instrumental"):
            return False
        return all(self.done(s) for s in (*PARALLEL_STAGES, *([LAST] if self.content_type == "song" else [])))

    def ready(self) -> list[str]:
        """Stages that may run now."""
        if self.status != "pending":
            return []
        for stage in (FIRST, SECOND):
            if not self.done(stage):
                return [stage] if self._open(stage) else []
        together = [s for s in PARALLEL_STAGES if self._open(s)]
        if together or not all(self.done(s) for s in PARALLEL_STAGES):
            return together
        return [LAST] if self.content_type == "song" and self._open(LAST) else []

    def _open(self, stage: str) -> bool:
        return stage not in self.stages or self.stages[stage].status == "pending"

    def apply(self, kind: str, stage: str | None, fingerprint: str | None, request: str | None, result: str | None, error: str | None) -> str | None:
        """One event; null when accepted, else why not."""
        if kind == "register":
            return self.register(fingerprint or "")
        if kind == "prepare":
            return self.prepare(stage or "", fingerprint or "")
        if kind == "claim":
            return self.claim(stage or "", fingerprint or "")
        if kind == "finish":
            return self.settle(stage or "", request or "", result, None)
        if kind == "fail":
            return self.settle(stage or "", request or "", None, error or "failed")
        if kind == "recover":
            self.recover()
            return None
        if kind == "publish":
            return self.publish()
        if kind == "unpublish":
            return self.unpublish()
        return f"unknown event {kind}"

    def dump(self) -> dict:
        return asdict(self)

    @classmethod
    def load(cls, value: dict) -> "Item":
        stages = {k: StageRow(**v) for k, v in value.pop("stages").items()}
        return cls(**value, stages=stages)
