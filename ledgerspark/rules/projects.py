"""Rule tables for project names and private identifiers.  All of them are configuration."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ProjectRules:
    """How raw project names become canonical ones; see ``functions.identifiers``.

    The values fit the names that ``plans.views`` makes, in which people work
    below ``/srv/<name>/git`` and teams are named after regions; another
    installation has its own.
    """

    #: Checkouts beside the project that are nobody's project.
    worktrees: tuple[str, ...] = (r"/[.]wt/[0-9]+$",)
    homes: tuple[str, ...] = (r"^-srv-[a-z]+-git[-_]", r"^git[-_]")
    #: The types of conventional commits, as branches are named.
    branches: tuple[str, ...] = ("build", "chore", "ci", "docs", "feat", "fix", "perf", "refactor", "revert", "style", "test")
    prefixes: tuple[str, ...] = ("team",)
    flat_root: str = "git_"
    flat_homes: tuple[str, ...] = (r"^/srv_[a-z]+_git_", r"^git_")
    #: A checkout's folder before the path inside it, and names that are hashes.
    checkout: str = r"^[A-Za-z0-9_]{8,}/repo/?"
    hashes: str = r"^[0-9a-f]{12,}$"
    remaps: tuple[tuple[str, str], ...] = (("holland", "netherlands"),)
    #: Names that are no project.
    noise: tuple[str, ...] = ("asia", "europe", "left-over")
    overrides: tuple[tuple[str, str], ...] = (("polar/north", "arctic"),)
    #: Folders that hold projects; of two that fit the first counts.
    containers: tuple[str, ...] = ("europe/alps/", "europe/", "asia/")
    #: Folders of every path.
    roots: tuple[str, ...] = ("srv", "git")


PROJECTS = ProjectRules()
#: Projects that are never published, and prefixes of such.
DENIED = ("secret_lab", "p3")
DENIED_PREFIXES = ("private_", "p1")
ALIASES = (("cash-book", "ledger"), ("p11", "p10"))
HOME_PATHS = (r"^/(Users|home)/[^/]+/", r"^/(private/)?tmp/", r"^/var/folders/[^/]+/[^/]+/")
#: Whatever looks like a private path, mail address or token.
SENSITIVE = (r"/(Users|home)/[A-Za-z0-9]+", r"-(Users|home)-[a-z0-9]+-", r"[A-Za-z0-9._]+@[A-Za-z0-9-]+\.[a-z]{2,}", r"(sk|ghp)_[A-Za-z0-9]{16,}")
UUID_SUFFIX = r"[/-][0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
