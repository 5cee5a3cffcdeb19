"""Job configuration records.

The pair/single/membership exchanges share one window build; what differs is
captured by a ``PoolJob`` record: how the registry yields (pool, token,
token_index), the pool share, excluded pools, and the pool-name prefix.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# Pools excluded from the Uniswap v2 build (wash-traded pairs).
UNISWAP_V2_EXCLUDED_POOLS = (
    "0xed9c854cb02de75ce4c9bba992828d6cb7fd5c71",
    "0x854373387e41371ac6e307a1f29603c6fa10d872",
)
# Balancer v2 vault: the one wallet that holds the tokens of all v2 pools.
BALANCER_V2_VAULT = "0xba12222222228d8ba445958a75a0704d566bf2c8"
# Native-coin placeholder, its wrapped token, and the Bancor hub token.
NATIVE_PLACEHOLDER = "0xeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeee"
WRAPPED_NATIVE = "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2"
BANCOR_HUB_TOKEN = "0x1f573d6fb3f13d689ff844b4ce37794d79a7ff1c"
BANCOR_HUB_SYMBOL = "BNT"
NATIVE_SYMBOL = "ETH"
# Pool-name prefixes of the label sets.
LABEL_PREFIX = {
    ("Uniswap", "1"): "Uni v1 LP ",
    ("Uniswap", "2"): "Uni v2 LP ",
    ("Uniswap", "3"): "Uni v3 LP ",
    ("Sushiswap", "1"): "Sushi v1 LP ",
    ("1inch", "1"): "1inch v1 LP ",
    ("Mooniswap", "1"): "Mooniswap v1 LP ",
    ("Bancor", "2"): "Bancor LP ",
    ("Balancer", "2"): "Balancer v2 LP ",
}
# Refresh policy: re-read this many stored days before a window, recompute
# this many days before the high-water mark, stop this long before now.
SEED_LOOKBACK_DAYS = 3
REFRESH_OVERLAP_DAYS = 3
REFRESH_END_LAG_MINUTES = 20
# ---------------------------------------------------------------------------

PAIR_INDEX = (("token0", "token_0"), ("token1", "token_1"))
MOONISWAP_INDEX = (("token1", "token_0"), ("token2", "token_1"))


@dataclass(frozen=True)
class PoolJob:
    """One exchange's daily build.

    registry_kind:
      "pair"       registry columns (pool_col, token columns) -> positions ``index``
      "single"     one token per pool, constant index ``constant_index``
      "membership" (pool, token) pairs from trades / transfers, constant index
    """

    project: str
    version: str
    registry_kind: str
    pool_col: str = "pair"
    index: tuple[tuple[str, str], ...] = PAIR_INDEX
    constant_index: str = "token_x"
    share: float | None = 0.5
    exclude: tuple = ()
    category: str = "DEX"
    active_within_days: int | None = None
    extra: dict = field(default_factory=dict)

    @property
    def label_prefix(self) -> str:
        return LABEL_PREFIX.get((self.project, self.version), f"{self.project} v{self.version} LP ")


JOBS = {
    "uniswap_v1": PoolJob("Uniswap", "1", "single", pool_col="exchange", constant_index="token_0"),
    "uniswap_v2": PoolJob("Uniswap", "2", "pair", exclude=UNISWAP_V2_EXCLUDED_POOLS),
    "uniswap_v3": PoolJob("Uniswap", "3", "pair", pool_col="pool"),
    "sushiswap_v1": PoolJob("Sushiswap", "1", "pair"),
    "mooniswap_v1": PoolJob("Mooniswap", "1", "pair", pool_col="mooniswap", index=MOONISWAP_INDEX),
    "1inch_v1": PoolJob("1inch", "1", "pair", pool_col="mooniswap", index=MOONISWAP_INDEX),
    "bancor_v2": PoolJob("Bancor", "2", "membership"),
    "curve_v1": PoolJob("Curve", "1", "membership", constant_index="token_x"),
    "balancer_v1": PoolJob("Balancer", "1", "membership", constant_index="token_0", share=None),
    # Drafts restricted to pools that traded in the last week.
    "sushiswap_v1_active": PoolJob("Sushiswap", "1", "pair", active_within_days=7),
    "mooniswap_v1_active": PoolJob("Mooniswap", "1", "pair", pool_col="mooniswap", index=MOONISWAP_INDEX,
                                   active_within_days=7),
}
