"""Everything a deployment chooses: endpoints, target ids, limits."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class MigrationConfig:
    """Hosts and ids are the caller's; the defaults are placeholders."""

    endpoints: dict[str, str] = field(
        default_factory=lambda: {
            name: f"https://target.invalid/{name}"
            for name in (
                "org",
                "user",
                "lender",
                "bulk",
                "contact",
                "contact_note",
                "contact_task",
                "mock",
                "fees",
                "participants",
                "sign_submission_status",
                "credit_consent",
                "credit_pull",
                "reference_mapping",
            )
        }
    )
    app_id: str = "target-app"
    entity_ids: dict[str, str] = field(
        default_factory=lambda: {
            "organization": "organization",
            "user_group": "users_group",
            "account": "account",
            "bdm": "lender_business_development_manager",
        }
    )
    acting_user_id: str = "migration"
    acting_user_role: str = "agent"
    # Attributes of an organization that the target knows by another name.
    renames: dict[str, str] = field(default_factory=dict)
    storage_base: str = "s3://documents"
    max_attempts: int = 2
    # Tasks of a delivery, each with a connection of its own. None derives the number from
    # the batch: at least the session's shuffle partitions, and one for so many records.
    delivery_partitions: int | None = None
    records_per_task: int = 20_000
    # Keep a journal of what was sent and answered, where the ledger's file system allows it.
    outbox: bool = True

    def endpoint(self, name: str, suffix: str = "") -> str:
        return self.endpoints[name] + suffix
