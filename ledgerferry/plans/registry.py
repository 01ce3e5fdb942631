"""Which entities there are, and in which order their requests can go.

A registry names entities with their specs and the requests their nested lists become. The order
of delivery is derived from it: a unit of work waits for the entities its foreign keys name, and
children that carry an answer wait for their parent. An application adds entities of its own with
`with_entity`; nothing else has to know them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from ledgerferry.config import MigrationConfig
from ledgerferry.plans.children import deal_children, manager_requests
from ledgerferry.plans.entities import SPECS, EntitySpec, ForeignKey


@dataclass(frozen=True)
class Children:
    """Requests that an entity's records bring along.

    `build(records, config)` makes them; with `answered`, `build(records, responses, config)`
    does, where responses (sk, seq, is_success, response) are those to the records themselves.
    """

    parent: str
    build: Callable[..., DataFrame]
    answered: bool = False


@dataclass(frozen=True)
class Unit:
    """What can go out together once the entities it needs are through."""

    name: str
    entity: str
    needs: frozenset[str]
    children: Children | None = None


@dataclass(frozen=True)
class EntityRegistry:
    specs: dict[str, EntitySpec]
    children: tuple[Children, ...] = ()

    def with_entity(self, name: str, spec: EntitySpec, *children: Callable[..., DataFrame] | Children) -> EntityRegistry:
        """A registry that also has this entity; plain functions are children without answers."""
        own = tuple(c if isinstance(c, Children) else Children(name, c) for c in children)
        made = replace(self, specs={**self.specs, name: spec}, children=(*self.children, *own))
        made.order()
        return made

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self.specs)

    def chain(self, entity: str) -> ForeignKey | None:
        """The key by which records of the entity need others of the same entity."""
        return next((k for k in self.specs[entity].keys if k.entity == entity), None)

    def units(self) -> list[Unit]:
        found = []
        for name, spec in self.specs.items():
            needs = frozenset(k.entity for k in spec.keys) - {name}
            found.append(Unit(name, name, needs))
        for number, c in enumerate(self.children):
            needs = frozenset({c.parent}) if c.answered else frozenset()
            found.append(Unit(f"{c.parent}_children_{number}", c.parent, needs, c))
        return found

    def order(self) -> list[list[str]]:
        """Entities by the number of steps they wait at least; keys in a circle are refused."""
        done: set[str] = set()
        steps = []
        left = {u.name: u for u in self.units() if not u.children}
        while left:
            ready = sorted(n for n, u in left.items() if not (u.needs & self.specs.keys()) - done)
            if not ready:
                raise ValueError(f"foreign keys in a circle: {', '.join(sorted(left))}")
            steps.append(ready)
            done |= set(ready)
            left = {n: u for n, u in left.items() if n not in ready}
        return steps


DEFAULT = EntityRegistry(
    SPECS,
    (Children("deal", deal_children), Children("lender", manager_requests, answered=True)),
)
