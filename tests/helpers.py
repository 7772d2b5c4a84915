import os

from lakepact.contract import Contract, Server

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def fixture_path(name: str) -> str:
    return os.path.join(FIXTURES, name)


def rebind(contract: Contract, env: str) -> Contract:
    """The same contract with its table servers moved to environment ``env``."""
    layer = str(contract.custom.get("capa", "")).lower()
    servers = tuple(
        Server(env, "lakehouse", f"{env}_{layer}", s.schema) if s.catalog else s
        for s in contract.servers if s.catalog or s.path
    )
    # keep one table server only, named after env
    table = [s for s in servers if s.catalog][:1]
    files = [s for s in servers if not s.catalog]
    return Contract(contract.id, contract.model, contract.physical_name, contract.fields, contract.rules,
                    tuple(files + table), contract.custom, contract.version, contract.status,
                    contract.description)
