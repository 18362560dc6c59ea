"""Rules and fixed values of the clip domain."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SliceRules:
    """Seconds."""

    skip_below: float = 10.0
    shortest: float = 2.0
    longest: float = 8.0
    slack: float = 0.3
    edge: float = 0.5


# Categories in order, with their position in a video.
CATEGORIES = {
    "开头钩子": "开头", "人设备书": "开头",
    "痛点描述": "中段", "旧法批判": "中段", "产品介绍": "中段", "原理说明": "中段",
    "使用方法": "中段", "使用场景": "中段", "效果承诺": "中段", "结果证明": "中段", "互动引导": "中段",
    "结尾转化": "结尾",
}
REVIEW = "待复核"
MIDDLE = "中段"

# Names of files that systems leave behind, as patterns; suffixes of documents and of videos.
JUNK = (".DS_Store", "Thumbs.db", "desktop.ini", ".pip_cache.json", "._*", "*.tmp", "*.temp", "~$*")
DOCUMENTS = (".txt", ".md", ".doc", ".docx", ".pdf", ".xls", ".xlsx")

# Endings after which a sentence goes on, and beginnings that continue one.
UNFINISHED_ENDS = (
    "呢", "吗", "吧", "呀", "啊", "么", "因为", "所以", "如果", "要是", "的话", "但是", "不过", "而且", "然后", "接着", "首先",
    "第一", "第二", "第三", "、", "的缝隙", "的地方", "的时候", "的里面", "的里边", "顺着", "通过", "经过", "按照",
)
CONTINUING_STARTS = ("是", "就是", "比如", "例如", "它", "他", "她", "这", "那", "窗户", "门", "墙")

# Delimiters of sentences, of caption lines, and of long transcript segments; colours; units of prices.
SENTENCE_MARKS = "，。！？；"
CAPTION_MARKS = "，。！？；、"
REFINE_MARKS = "，。？！；："
COLOURS = "红黄蓝绿黑白紫灰棕"
PRICE_UNITS = "块元"
HIGHLIGHT_UNITS = "元块包"
CHARS_A_SECOND = 4.5
