"""URL expressions with the semantics of Python's ``urllib.parse``.

``parse_url`` is not used: under ANSI mode it raises on odd input, and its
``HOST`` loses user info and port.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from linkloom.constants import IGNORED_HOST_PARTS
from linkloom.functions.local import bind

SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
SCHEME_RE = rf"^({SCHEME}):"
NETLOC_RE = rf"^(?:{SCHEME}:)?//([^/?#]*)"
PATH_RE = rf"^(?:{SCHEME}:)?(?://[^/?#]*)?([^?#]*)"
QUERY_RE = r"^[^?#]*\?([^#]*)"
FRAGMENT_RE = r"(?s)^[^#]*#(.*)$"

# Schemes whose URLs have a host, resolve relative links and have path parameters.
WITH_HOST = (
    "ftp http gopher nntp telnet imap wais file mms https shttp snews prospero rtsp rtsps rtspu rsync svn svn+ssh sftp"
    " nfs git git+ssh ws wss itms-services"
).split()
RELATIVE = ["", *"ftp http gopher nntp imap wais file https shttp mms prospero rtsp rtsps rtspu sftp svn svn+ssh ws wss".split()]
WITH_PARAMS = ["", *"ftp hdl prospero http imap https shttp rtsp rtsps rtspu sip sips mms sftp tel".split()]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean(url: Column | str) -> Column:
    """Drop leading control characters and blanks, and tabs and line ends anywhere."""
    return F.translate(F.regexp_replace(_c(url), r"^[\x00-\x20]+", ""), "\t\r\n", "")


def scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(clean(url), SCHEME_RE, 1))


def netloc(url: Column | str) -> Column:
    return F.regexp_extract(clean(url), NETLOC_RE, 1)


def full_path(url: Column | str) -> Column:
    """Path together with the ``;parameters`` of its last segment."""
    return F.regexp_extract(clean(url), PATH_RE, 1)


def path(url: Column | str) -> Column:
    return _without_params(full_path(url), scheme(url))


def _without_params(whole: Column, sch: Column) -> Column:
    """Path before the first ``;`` of its last segment, where the scheme has parameters."""
    return F.when(sch.isin(WITH_PARAMS), F.regexp_replace(whole, r";[^/]*$", "")).otherwise(whole)


def _params(whole: Column, sch: Column) -> Column:
    return F.when(sch.isin(WITH_PARAMS), F.regexp_extract(whole, r";([^/]*)$", 1)).otherwise(F.lit(""))


def query(url: Column | str) -> Column:
    return F.regexp_extract(clean(url), QUERY_RE, 1)


def fragment(url: Column | str) -> Column:
    return F.regexp_extract(clean(url), FRAGMENT_RE, 1)


def url_parts(url: Column | str) -> Column:
    return F.struct(
        scheme(url).alias("scheme"),
        netloc(url).alias("netloc"),
        path(url).alias("path"),
        query(url).alias("query"),
        fragment(url).alias("fragment"),
    )


def site_url(url: Column | str) -> Column:
    return F.concat(scheme(url), F.lit("://"), netloc(url))


def site_name(host: Column | str) -> Column:
    """Naming part of a host: the first part that is not on the ignore list.

    Where that part has at most three characters and another one is left, the
    other one is taken; where every part is ignored, the very first one.
    """

    def pick(parts: Column) -> Column:
        kept = F.filter(parts, lambda part: ~F.lower(part).isin(list(IGNORED_HOST_PARTS)))
        return bind(kept, lambda k: choose(parts, k))

    def choose(parts: Column, kept: Column) -> Column:
        first, second = F.get(kept, F.lit(0)), F.get(kept, F.lit(1))
        return (
            F.when(F.size(kept) == 0, F.get(parts, F.lit(0)))
            .when((F.size(kept) > 1) & (F.length(first) <= 3), second)
            .otherwise(first)
        )

    return bind(F.split(_c(host), r"\."), pick)


def site_norm(url: Column | str) -> Column:
    """Protocol-free form: host without any ``www.``, path without closing slashes."""
    host = F.replace(netloc(url), F.lit("www."), F.lit(""))
    return F.concat(host, F.regexp_replace(path(url), "/+$", ""))


def _marked(mark: str, part: Column) -> Column:
    return F.when(F.length(part) > 0, F.concat(F.lit(mark), part)).otherwise(F.lit(""))


def link_norm(url: Column | str) -> Column:
    return F.concat(site_norm(url), _marked("?", query(url)), _marked("#", fragment(url)))


def _assemble(u: Column) -> Column:
    """URL of the parts scheme, host, path, params, query and fragment."""

    def put(whole: Column) -> Column:
        rooted = (whole == "") | whole.startswith("/")
        body = (
            F.when(u["host"] != "", F.concat(F.lit("//"), u["host"], F.when(rooted, F.lit("")).otherwise(F.lit("/")), whole))
            .when(whole.startswith("//") | (u["scheme"].isin(WITH_HOST) & rooted), F.concat(F.lit("//"), whole))
            .otherwise(whole)
        )
        prefix = F.when(u["scheme"] != "", F.concat(u["scheme"], F.lit(":"))).otherwise(F.lit(""))
        return F.concat(prefix, body, _marked("?", u["query"]), _marked("#", u["fragment"]))

    return bind(F.concat(u["path"], _marked(";", u["params"])), put)


def _parts(**parts: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in parts.items()])


def _split(url: Column, default: Column | None = None) -> Column:
    """The parts of a URL; a scheme it lacks is ``default``."""

    def parts(s: Column) -> Column:
        sch = s["scheme"] if default is None else F.when(s["scheme"] != "", s["scheme"]).otherwise(default)
        return _parts(
            scheme=sch,
            host=netloc(url),
            path=_without_params(s["whole"], sch),
            params=_params(s["whole"], sch),
            query=query(url),
            fragment=fragment(url),
        )

    return bind(_parts(scheme=scheme(url), whole=full_path(url)), parts)


def strip_fragment(url: Column | str) -> Column:
    """URL without its fragment; an empty query mark goes, the scheme is lowered."""
    return bind(_split(_c(url)), lambda u: _assemble(u.withField("fragment", F.lit(""))))


def _remove_dots(segments: Column) -> Column:
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        empty,
        lambda done, seg: F.when(seg == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(seg == ".", done)
        .otherwise(F.array_append(done, seg)),
    )
    ends_open = F.element_at(segments, -1).isin(".", "..")
    closed = F.when(ends_open, F.array_append(kept, F.lit(""))).otherwise(kept)
    joined = F.array_join(closed, "/")
    return F.when(joined == "", F.lit("/")).otherwise(joined)


def _target_path(base_path: Column, path_: Column) -> Column:
    """Path of a link by the path of its base, dot segments removed."""
    # A relative path hangs below the folder of the base; inner empty parts vanish.
    folder = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_replace(base_path, "[^/]*$", ""))

    def relative(merged: Column) -> Column:
        inner = F.filter(F.slice(merged, F.lit(2), F.greatest(F.size(merged) - 2, F.lit(0))), lambda s: s != "")
        return F.when(
            F.size(merged) > 1,
            F.concat(F.slice(merged, F.lit(1), F.lit(1)), inner, F.slice(merged, F.lit(-1), F.lit(1))),
        ).otherwise(merged)

    # Only rooted paths that hold a dot segment pay for the segment walk.
    plain = path_.startswith("/") & ~path_.contains("/.")
    segments = F.when(path_.startswith("/"), F.split(path_, "/")).otherwise(
        bind(F.split(F.concat(folder, path_), "/"), relative)
    )
    return F.when(plain, path_).otherwise(bind(segments, _remove_dots))


def resolve_link(base: Column | str, href: Column | str) -> Column:
    """Absolute form of ``href`` found on page ``base`` (RFC 3986, section 5.2)."""
    base = _c(base)
    return bind(_split(base), lambda b: resolve_against(base, b, _c(href)))


def resolve_against(base: Column, parts: Column, href: Column) -> Column:
    """``resolve_link`` for a base that was split before."""

    def resolve(h: Column) -> Column:
        foreign = (h["scheme"] != parts["scheme"]) | ~h["scheme"].isin(RELATIVE)
        own_host = (h["host"] != "") & h["scheme"].isin("", *WITH_HOST)
        same = (h["path"] == "") & (h["params"] == "")
        inherited = F.when(h["query"] != "", h["query"]).otherwise(parts["query"])
        target = _parts(
            scheme=h["scheme"],
            host=F.when(own_host, h["host"]).otherwise(parts["host"]),
            path=F.when(own_host, h["path"]).when(same, parts["path"]).otherwise(_target_path(parts["path"], h["path"])),
            params=F.when(~own_host & same, parts["params"]).otherwise(h["params"]),
            query=F.when(own_host | ~same, h["query"]).otherwise(inherited),
            fragment=h["fragment"],
        )
        return (
            F.when(href == "", base).when(base == "", href).when(foreign, href).otherwise(bind(target, _assemble))
        )

    return bind(_split(href, parts["scheme"]), resolve)


def split_base(base: Column | str) -> Column:
    return _split(_c(base))
