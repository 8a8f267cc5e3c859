"""Column roles: which columns of a snapshot table play which part."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Names of the columns the operators work on.

    One row describes one measured entity in one snapshot; after cleaning,
    ``(entity_id, snapshot_date)`` is unique.
    """

    entity_id: str = "entity_id"
    entity_name: str = "entity_name"
    group_name: str = "group_name"
    snapshot_date: str = "snapshot_date"
    quality: str = "quality"
    speed: str = "speed"
    price_in: str = "price_in"
    price_out: str = "price_out"

    @property
    def identity(self) -> list[str]:
        return [self.entity_id, self.entity_name, self.group_name]

    @property
    def metrics(self) -> list[str]:
        return [self.quality, self.speed, self.price_in, self.price_out]

    @property
    def columns(self) -> list[str]:
        return [*self.identity, self.snapshot_date, *self.metrics]


DEFAULT_ROLES = Roles()
