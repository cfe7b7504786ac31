"""String functions as column expressions. All are null in, null out unless they say otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "webp", "bmp", "gif")
VIDEO_SUFFIXES = ("mp4", "avi", "mkv", "mov", "webm", "flv")
MIME_SUFFIXES = {"image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/bmp": ".bmp", "image/gif": ".gif"}
SOURCE_MARKS = (
    ("unsplash", ("unsplash",)),
    ("pexels", ("pexels",)),
    ("flickr", ("flickr", "staticflickr")),
    ("wikimedia", ("wikimedia", "wikipedia")),
    ("nasa", ("nasa", "earthobservatory")),
)
THUMBNAIL_MARKS, LARGE_MARK = ("_th.", "_thumb.", "_med.", "_small."), "_lrg."
PROMPT_SUFFIX = ", photorealistic, 1080p, high quality, detailed"
#: Styles of log levels, in order of severity; days that logs and error logs are kept.
LEVEL_STYLES = {"DEBUG": "dim", "INFO": "cyan", "SUCCESS": "green", "WARNING": "yellow", "ERROR": "red", "CRITICAL": "bold red"}
LOG_DAYS, ERROR_DAYS = 7, 30
BOT_MARKS = ("Sign in to confirm", "bot", "captcha")
_SPACE = r"[\s ]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """White space off both ends, not only spaces as with trim."""
    return F.regexp_replace(_col(c), rf"^{_SPACE}|{_SPACE}$", "")


def keyword_dir(c: Column | str) -> Column:
    """A keyword as the name of a directory: no characters that file systems reserve, spaces as underscores."""
    return F.replace(strip(F.regexp_replace(_col(c), r'[<>:"/\\|?*]', "")), F.lit(" "), F.lit("_"))


def suffix(path: Column | str) -> Column:
    """The lower-cased suffix of a path's last part, without its dot; empty without one."""
    return F.lower(F.regexp_extract(_col(path), r"[^/]\.([^./]+)$", 1))


def is_image(path: Column | str) -> Column:
    return suffix(path).isin(*IMAGE_SUFFIXES)


def is_video(path: Column | str) -> Column:
    return suffix(path).isin(*VIDEO_SUFFIXES)


def url_extension(url: Column | str) -> Column:
    """The suffix, with its dot, of a URL up to its query; null if it isn't an image's. A fragment is part of the path."""
    found = suffix(F.split_part(_col(url), F.lit("?"), F.lit(1)))
    return F.when(found.isin(*IMAGE_SUFFIXES), F.concat(F.lit("."), found))


def mime_extension(mime: Column | str) -> Column:
    """The suffix of a MIME type; null for others and for types with parameters."""
    pairs = [F.lit(x) for pair in MIME_SUFFIXES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(_col(mime)))


def source_of_url(url: Column | str) -> Column:
    """The first source one of whose marks is in the URL, or 'unknown'."""
    low, found = F.lower(_col(url)), None
    for name, marks in SOURCE_MARKS:
        hit = low.contains(marks[0])
        for mark in marks[1:]:
            hit |= low.contains(mark)
        found = F.when(hit, name) if found is None else found.when(hit, name)
    return found.otherwise("unknown")


def large_variant(url: Column | str) -> Column:
    """A thumbnail's URL as its large version's: every occurrence of the first mark that is there is replaced."""
    url, found = _col(url), None
    for mark in THUMBNAIL_MARKS:
        new = F.replace(url, F.lit(mark), F.lit(LARGE_MARK))
        found = F.when(url.contains(mark), new) if found is None else found.when(url.contains(mark), new)
    return found.otherwise(url)


def absolute_url(url: Column | str, base: Column | str) -> Column:
    """The base put before a URL that doesn't begin with http."""
    url = _col(url)
    return F.when(url.startswith("http"), url).otherwise(F.concat(base if isinstance(base, Column) else F.lit(base), url))


def photo_url(server: Column | str, photo: Column | str, secret: Column | str) -> Column:
    """A photo's address from its parts; null unless all are there and not empty."""
    parts = [F.nullif(_col(c), F.lit("")) for c in (server, photo, secret)]
    return F.concat(F.lit("https://live.staticflickr.com/"), parts[0], F.lit("/"), parts[1], F.lit("_"), parts[2], F.lit("_b.jpg"))


def quoted(c: Column | str) -> Column:
    """Percent-encoding with %20 for a space and / as it is."""
    return F.replace(F.replace(F.url_encode(_col(c)), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def search_url(engine: str, keyword: Column | str) -> Column:
    """Where an engine's image search begins."""
    if engine == "bing":
        return F.concat(F.lit("https://www.bing.com/images/search?q="), quoted(keyword), F.lit("&count=150"))
    return F.concat(F.lit("https://www.google.com/search?q="), _col(keyword), F.lit("&tbm=isch&ijn=0"))


def video_search(platform: str, most: int, keyword: Column | str) -> Column:
    """What a video search is asked: a platform's name, how many results, the keyword."""
    return F.concat(F.lit(f"{'yt' if platform == 'youtube' else platform}search{most}:"), _col(keyword))


def first_filled(*columns: Column | str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(_col(c), F.lit("")) for c in columns))


def video_url(url: Column | str, video: Column | str, prefix: str) -> Column:
    """A video's own address, or else its site's with its id; null without both."""
    return F.coalesce(F.nullif(_col(url), F.lit("")), F.concat(F.lit(prefix), F.nullif(_col(video), F.lit(""))))


def truncated(c: Column | str, most: int) -> Column:
    """At most so many characters; null if empty."""
    return F.nullif(F.left(_col(c), F.lit(most)), F.lit(""))


def output_name(path: Column | str) -> Column:
    """The names of the parent directory and the file, joined by an underscore."""
    parts = F.split(_col(path), "/")
    return F.concat_ws("_", F.try_element_at(parts, F.lit(-2)), F.element_at(parts, -1))


def numbered_name(prefix: Column | str, index: Column | str, ending: str) -> Column:
    """A prefix and a number of five digits."""
    return F.format_string(f"%s_%05d{ending}", _col(prefix), _col(index))


def keyword_list(c: Column | str) -> Column:
    """The trimmed, non-empty parts of a comma-separated list."""
    return F.filter(F.transform(F.split(_col(c), ",", -1), strip), lambda x: x != "")


def prompt_lines(c: Column | str) -> Column:
    """The trimmed, non-empty lines of a text."""
    return F.filter(F.transform(F.split(_col(c), "\r\n|\r|\n", -1), strip), lambda x: x != "")


def enhanced_prompt(c: Column | str) -> Column:
    return F.concat(_col(c), F.lit(PROMPT_SUFFIX))


def is_thumbnail_source(src: Column | str) -> Column:
    """Whether a lower-case address is of a picture."""
    return _col(src).rlike(r"\.(jpg|jpeg|png)")


def is_decoration(src: Column | str) -> Column:
    return _col(src).rlike("icon|logo|button")


def blocked_as_bot(message: Column | str, marks: tuple[str, ...] = BOT_MARKS) -> Column:
    """Whether an error message hints that the other side took us for a robot."""
    return F.exists(F.array(*(F.lit(m) for m in marks)), lambda m: F.contains(_col(message), m))


def log_line(time: Column | str, level: Column | str, message: Column | str) -> Column:
    """A log record as one line, in its level's style; unknown levels have none."""
    level = _col(level)
    text = F.rtrim(F.concat_ws(" | ", F.date_format(_col(time), "HH:mm:ss"), F.rpad(level, F.greatest(F.lit(8), F.char_length(level)), " "), _col(message)))
    style = F.try_element_at(F.create_map(*(F.lit(x) for pair in LEVEL_STYLES.items() for x in pair)), level)
    return F.coalesce(F.concat(F.lit("["), style, F.lit("]"), text, F.lit("[/"), style, F.lit("]")), text)


def logged(time: Column | str, level: Column | str, now: Column, errors: bool = False) -> Column:
    """Whether a record belongs in the log, or in the log of errors, as they are kept for so many days."""
    kept = _col(time) >= now - F.make_dt_interval(F.lit(ERROR_DAYS if errors else LOG_DAYS))
    severe = [name for name in LEVEL_STYLES if not errors or name in ("ERROR", "CRITICAL")]
    return kept & _col(level).isin(*severe)


def translated(strings: dict[str, dict[str, str]], language: Column | str, key: Column | str, **cells: Column | str) -> Column:
    """A key's text in a language, with ``{name}`` replaced by the named columns; English for languages that aren't there, the key itself for keys that aren't."""
    language, key = _col(language), _col(key)
    own = F.when(language.isin(*strings), language).otherwise("en")
    table = [F.lit(x) for name, texts in strings.items() for k, text in texts.items() for x in (f"{name}\x1f{k}", text)]
    text = F.coalesce(F.try_element_at(F.create_map(*table), F.concat(own, F.lit("\x1f"), key)), key) if table else key
    for name, cell in cells.items():
        text = F.replace(text, F.lit(f"{{{name}}}"), _col(cell).cast("string"))
    return text
