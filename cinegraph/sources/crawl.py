"""The crawl target grid (facets x page offsets).

The HTTP client itself is not built; its response parsing is ``files.normalise_crawl``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the search facets of the crawl, in the reference's order
FORM_TAGS = ['电影', '电视剧', '综艺', '动画', '纪录片', '短片']
TYPE_TAGS = ['剧情', '喜剧', '动作', '爱情', '科幻', '悬疑', '惊悚', '恐怖', '犯罪', '同性', '音乐', '歌舞', '传记',
             '历史', '战争', '西部', '奇幻', '冒险', '灾难', '武侠', '情色']
COUNTRY_TAGS = ['中国大陆', '美国', '香港', '台湾', '日本', '韩国', '英国', '法国', '德国', '意大利', '西班牙', '印度',
                '泰国', '俄罗斯', '伊朗', '加拿大', '澳大利亚', '爱尔兰', '瑞典', '巴西', '丹麦']
GENRES_TAGS = ['经典', '青春', '文艺', '搞笑', '励志', '魔幻', '感人', '女性', '黑帮']
# fixed values: the crawl's selection (film, war, the 2nd to 8th country) and page step
CRAWL_FORM = '电影'
CRAWL_TYPE = '战争'
CRAWL_COUNTRIES = COUNTRY_TAGS[1:8]
PAGE_STEP = 20


def facet_grid(spark: SparkSession) -> DataFrame:
    """J9 + F9: the cross product of the (small, fixed) facet lists, filtered to the
    crawl's selection.  Each list is a handful of literals, so the product is
    built from array literals with ``explode`` (no join)."""
    arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    g = (spark.range(1)
         .select(F.explode(arr(FORM_TAGS)).alias("form"))
         .select("form", F.explode(arr(TYPE_TAGS)).alias("Type"))
         .select("form", "Type", F.explode(arr(COUNTRY_TAGS)).alias("country"))
         .select("form", "Type", "country", F.explode(arr(GENRES_TAGS)).alias("genres")))
    return g.where((F.col("form") == CRAWL_FORM) & (F.col("Type") == CRAWL_TYPE)
                   & F.col("country").isin(CRAWL_COUNTRIES))


def crawl_requests(grid: DataFrame, max_start: int) -> DataFrame:
    """Page offsets 0, 20, ... max_start for every grid point."""
    return grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_start), F.lit(PAGE_STEP))).alias("start"))
