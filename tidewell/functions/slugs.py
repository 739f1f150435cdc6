"""Board slugs of hosted job boards from URLs: a rules table compiled to Columns.

A rule names a platform, a pattern of hosts, one of paths and a template whose parts are
joined by "|". A part is h (the host pattern's group), p1, p2, .. (the path pattern's
groups), q:name (a query value) or =text. A part may be followed by :l or :u (lower or
upper case). The first part must not be a reserved name; the parts in `real` must look
like a slug. A new platform is one more row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions import urls

#: Names that are never a board.
RESERVED = (
    "", "api", "www", "app", "static", "assets", "cdn", "docs", "help", "support", "blog", "login", "register", "test", "demo", "example", "staging", "dev",
    "sandbox", "admin", "careers", "embed", "job_board", "js", "widget", "iframe",
)
#: Path segments that are files or services.
GENERIC = ("assets", "static", "public", "robots.txt", "sitemap.xml", "sitemap", "favicon.ico", "manifest.json", "wp-content", "wp-includes", ".well-known", "cdn-cgi", "api", "health", "healthz", "ping")
#: Hosts of a vendor that are no tenants.
VENDOR_HOSTS = (
    "support", "developers", "api", "help", "docs", "blog", "status", "community", "learn", "marketplace", "partners", "careers", "jobs", "go", "info", "mail", "email", "admin",
    "login", "my", "static", "assets", "cdn", "app", "apps", "demo", "sandbox", "staging", "test", "resources", "helpcenter", "portal", "kb", "adpsupport",
)
MANATAL_PAGES = (
    "job", "jobs", "login", "logout", "signup", "register", "terms", "privacy", "about", "contact", "pricing", "help", "support", "static", "media",
    "career", "careers", "career-page", "employer", "candidate", "candidates",
)
RECRUITERFLOW_PAGES = (
    "jobs", "blog", "pricing", "features", "login", "signup", "api", "about", "contact", "careers", "customers", "integrations", "resources", "demo", "partners",
    "support", "legal", "privacy", "terms", "company",
)
#: Words at the end of a posting's own slug, and words in it.
ROLE_ENDS = "manager|director|engineer|analyst|specialist|coordinator|associate|assistant|officer|lead|head|representative|executive|consultant|administrator|supervisor|technician|developer"
TITLE_WORDS = (
    "senior|junior|sr|jr|entry-level|full-time|part-time|remote|marketing|sales|customer|account|product|project|program|operations|finance|human-resources|software|data|"
    "business-development|engineering"
)
#: Words with which the names of a page's actions begin.
ACTIONS = "refresh|clear|load|reload|search|filter|toggle|apply|remove|add|fetch|get|set|update|reset|submit|open|close|show|hide|select|dismiss|expand|collapse"
FILES = "png|jpe?g|gif|svg|webp|ico|bmp|css|js|mjs|woff2?|ttf|eot|pdf|mp4|webm|json|map|txt|xml"


def is_posting_slug(s: Column) -> Column:
    """Shaped like one posting's page."""
    ends = s.rlike(r"(?i)[-_](job-description|job-details|position-description|job-posting)$") | s.rlike(r"[-_]\d{4,}$")
    return ends | (s.rlike(rf"(?i)[-_]({ROLE_ENDS})s?$") & s.rlike(rf"(?i)({TITLE_WORDS})[-_]"))


def is_real(s: Column) -> Column:
    """Could be a company's slug: no file, hash, locale, service or posting."""
    bad = (
        (s == "")
        | s.contains("/")
        | s.rlike(r"(?i)^wd\d{1,3}\|[^|]*\|[^|]*$")
        | F.lower(s).isin(*GENERIC)
        | s.rlike(rf"(?i)\.({FILES})$")
        | s.rlike(r"(?i)^[0-9a-f]{16,64}$")
        | s.rlike(r"^[a-z]{2}(-[A-Z]{2})?$")
        | is_posting_slug(s)
    )
    return ~bad


@dataclass(frozen=True)
class Rule:
    platform: str
    host: str
    path: str = ""
    parts: tuple[str, ...] = ("h",)
    real: tuple[int, ...] = ()
    unlike: tuple[str, ...] = ()
    shape: str = ""
    reserved: bool = True


def _sub(platform: str, *suffixes: str, dotted: bool = True, **more) -> Rule:
    """The sub-domain of one of the suffixes."""
    label = r"[^/]+" if dotted else r"[^./]+"
    return Rule(platform, rf"^({label})\.(?:{'|'.join(x.replace('.', chr(92) + '.') for x in suffixes)})$", **more)


def _seg(platform: str, *hosts: str, path: str = r"^/+([^/]+)", **more) -> Rule:
    """A path segment on one of the hosts."""
    return Rule(platform, rf"^(?:{'|'.join(x.replace('.', chr(92) + '.') for x in hosts)})$", path, **({"parts": ("p1",)} | more))


TENANT = r"^[a-z0-9][a-z0-9-]*$"
WORD = r"^[a-z0-9][a-z0-9_-]*$"
DOTTED = r"^[a-z0-9][a-z0-9._-]*$"
_GREENHOUSE = ("boards.greenhouse.io", "boards.eu.greenhouse.io", "job-boards.greenhouse.io", "job-boards.eu.greenhouse.io")
_LOCALE = r"(?:[a-z]{2}(?:-[A-Za-z]{2})?/)?"
_WWW = ("www",)

#: The rules in order of precedence; several rows of one platform are tried in turn.
RULES = (
    _seg("greenhouse", *_GREENHOUSE, path=r"^/+embed/", parts=("q:for",), real=(0,)),
    _seg("greenhouse", *_GREENHOUSE, path=r"^/+(?!embed/)([^/]+)", real=(0,)),
    Rule("lever", r"^(?:.+\.)?lever\.co$", r"^/+([^/]+)", ("p1",), (0,)),
    _seg("ashby", "jobs.ashbyhq.com", parts=("p1:d",), real=(0,)),
    _sub("bamboohr", "bamboohr.com", unlike=_WWW),
    Rule("icims", r"^(?:(?:[a-z]{2}careers\d*|careers\d*|career\d*|jobs\d*|hiring|employment|recruiting|talent)-)?([^/]+)\.icims\.com$"),
    Rule("workday", r"^([^./]+)\.([^./]+)\.(?:.*\.)?myworkdayjobs\.com$", rf"^/+{_LOCALE}([^/]+)", ("h", "h2", "p1"), (2,), reserved=False, shape=rf"^(?!.*\|(?:{ACTIONS})[A-Z]\w*$)(?!(?i:.*\|(?:{ACTIONS})$)).+\|.+\|.+$"),
    Rule("rippling", r"rippling\.com", r"^/+(?:[a-z]{2}(?:-[A-Za-z]{2})?/(?!(?i:jobs)(?:/|$))(?=[^/]+/))?([^/]+)/(?:[^/]+/)*(?i:jobs)(?:/|$)", ("p1",), (0,)),
    _sub("rippling", "rippling.com", unlike=("www", "app", "ats"), real=(0,)),
    _seg("workable", "apply.workable.com", parts=("p1:l",), unlike=("j", "i")),
    _sub("workable", "workable.com", unlike=("www", "apply", "jobs", "help", "careers", "jobseekers", "partners", "support", "grow")),
    _sub("recruitee", "recruitee.com", unlike=_WWW),
    _seg("smartrecruiters", "jobs.smartrecruiters.com", "careers.smartrecruiters.com", unlike=("jobs", "careers", "posting")),
    Rule("taleo", r"^[^/]*\.?tbe\.taleo\.net$", r"(?i)^/([a-z0-9]+)/ats/careers/v2/", ("=tbe", "p1:l", "q:org", "h1", "q:cws"), shape=r"^tbe\|[a-z0-9]+\|[A-Za-z0-9_-]+\|[a-z0-9]+\|\d{1,4}$", reserved=False),
    _sub("taleo", "taleo.net", path=r"/careersection/([^/]+)/", parts=("h", "p1")),
    _sub("oracle_cloud_hcm", "oraclecloud.com", path=r"(?i)/hcmui/candidateexperience/.*?/sites/([^/]+)", parts=("h", "p1")),
    _sub("oracle_cloud_hcm", "oraclecloud.com", path=r"(?i)/hcmui/candidateexperience/"),
    Rule("brassring", r"brassring\.com$", "", ("q:partnerid", "q:siteid"), shape=r"^\d+\|\d+$", reserved=False),
    _sub("teamtailor", "teamtailor.com", unlike=("www", "app", "scripts", "cdn", "support")),
    _sub("breezyhr", "breezy.hr", unlike=_WWW),
    _sub("applytojob", "applytojob.com", unlike=_WWW),
    _sub("hrmdirect", "hrmdirect.com", "clearcompany.com", unlike=_WWW),
    _sub("softgarden", "career.softgarden.de", "softgarden.io", "softgarden.de", dotted=False, unlike=("www", "certificate", "a-tile", "b-tile", "c-tile")),
    Rule("softgarden", r"softgarden", r"/jobboards/([^/.]+)(?:/|$)", ("p1",), reserved=False),
    _sub("zoho", "zohorecruit.com", "zohorecruit.eu", "zohorecruit.com.au", unlike=_WWW),
    Rule("paylocity", r"paylocity\.com$", r"(?i)/recruiting/jobs/[^/]+/([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})/([^/]+)", ("p1", "p2"), reserved=False),
    _sub("personio", "jobs.personio.de", "jobs.personio.com", unlike=_WWW),
    Rule("joincom", r"^(?:www\.)?join\.com$", r"/companies/([^/]+)", ("p1:l",)),
    _sub("eploy", "eploy.net", dotted=False, unlike=_WWW),
    Rule("folkshr", r"folksats\.app|glowinthecloud\.com", r"^/+([^/]+)", ("p1:l",), (0,)),
    Rule("jobadder", r"jobadder\.com$", r"^/+([^/]+)/([^/]+)", ("p1", "p2"), (0, 1), unlike=("vendors", "lib")),
    Rule("jobvite", r"jobvite\.com", r"(?i)careers\.aspx", ("q:c",)),
    Rule("jobvite", r"jobvite\.com", r"^/+(?!(?i:.*careers\.aspx))(?:(?i:careers)/)?([^/]+)", ("p1:l",)),
    Rule("adp", r"adp\.com$", "", ("q:cid", "q:ccId"), shape=r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\|\d+_\d+$", reserved=False),
    _sub("avature", "avature.net", unlike=_WWW),
    Rule("pageup", r"pageuppeople\.com", r"^/+(\d+)/([^/]+)", ("p1", "p2")),
    _sub("pinpoint", "pinpointhq.com", unlike=_WWW),
    _seg("flatchr", "careers.flatchr.io", path=r"^/company/([^/]+)", parts=("p1:l",)),
    _sub("flatchr", "flatchr.io", unlike=("www", "careers")),
    _seg("jobylon", "emp.jobylon.com", path=r"^/companies/([^/]+)"),
    _seg("dayforce", "jobs.dayforcehcm.com", path=r"^/api/geo/([^/]+)/?$", real=(0,)),
    _seg("dayforce", "jobs.dayforcehcm.com", path=r"^/[a-z]{2}(?:-[A-Za-z]{2})?/([^/]+)/(?!(?i:candidateportal)(?:/|$))([A-Za-z0-9_-]+)(?:/|$)", parts=("p1", "p2"), real=(0,)),
    _seg("dayforce", "jobs.dayforcehcm.com", path=r"^/[a-z]{2}(?:-[A-Za-z]{2})?/([^/]+)(?:/|$)", real=(0,)),
    _sub("getro", "getro.com", unlike=("www", "app"), real=(0,)),
    _sub("csod", "csod.com", path=r"(?i)^/ux/ats/careersite/(\d+)/", parts=("h", "p1"), unlike=_WWW, real=(0,)),
    _sub("csod", "csod.com", parts=("h", "=1"), unlike=_WWW, real=(0,)),
    _seg("paycom", "www.paycomonline.net", "paycomonline.net", path=r"^/v4/ats/web\.php/portal/([0-9A-Fa-f]{32})(?:/|$)", parts=("p1:u",)),
    _sub("jazzhr", "applytojob.com", unlike=_WWW, shape=TENANT, real=(0,)),
    _seg("hireology", "careers.hireology.com", parts=("p1:l",)),
    _sub("hirehive", "hirehive.com", dotted=False, unlike=("www", "app", "api", "blog", "help", "support", "status")),
    _seg("manatal", "careers-page.com", "www.careers-page.com", parts=("p1:l",), real=(0,), unlike=MANATAL_PAGES, shape=DOTTED),
    _seg("jobscore", "careers.jobscore.com", path=r"^/(?:careers|jobs)/([^/]+)", parts=("p1:l",)),
    _seg("crelate", "jobs.crelate.com", path=r"^/+(?i:portal)/(?:(?i:v2)/(?=[^/]))?([^/]+)", parts=("p1:l",), shape=DOTTED),
    _seg("comeet", "www.comeet.com", "comeet.com", "www.comeet.co", "comeet.co", path=r"^/+(?i:jobs)/([^/]+)/([^/]+)", parts=("p1:l", "p2:u"), shape=r"^[a-z0-9][a-z0-9._-]*\|[0-9A-Z]{2,3}\.[0-9A-Z]{3}$"),
    _sub("emply", "career.emply.com", unlike=("www", "app"), shape=TENANT),
    _sub("cats", "catsone.com", path=r"/careers/(\d+)", parts=("h", "p1"), unlike=("www", "app"), shape=r"^[a-z0-9][a-z0-9-]*\|\d+$"),
    _sub("elmo", "elmotalent.com.au", path=r"^/careers/([^/]+)", parts=("h", "p1"), unlike=("www", "app")),
    _sub("easyapply", "easyapply.co", unlike=("www", "app"), shape=TENANT),
    _sub("hibob", "careers.hibob.com", unlike=("www", "app"), shape=TENANT),
    _seg("deel", "jobs.deel.com", path=r"^/+(?:job-boards/)?([^/]+)", parts=("p1:l",), unlike=("auth", "login", "signup", "guest", "api", "deelapi", "job-boards", "job-details"), shape=WORD),
    _sub("applicantpro", "applicantpro.com", unlike=("www", "app"), shape=TENANT),
    _sub("traffit", "traffit.com", unlike=("www", "app", "api", "cdn", "cdn3", "help", "knowledge"), shape=TENANT),
    _sub("freshteam", "freshteam.com", unlike=("www", *VENDOR_HOSTS), shape=TENANT),
    _sub("peopleforce", "peopleforce.io", unlike=("www", *VENDOR_HOSTS), shape=TENANT),
    _sub("factorial", "factorial.com", "factorialhr.com", unlike=("www", *VENDOR_HOSTS), shape=TENANT),
    _seg("loxo", "app.loxo.co", parts=("p1:l",), unlike=("job", "jobs", "login", "users", "api", "assets", "static", "careers"), shape=WORD, reserved=False),
    _sub("careerplug", "careerplug.com", unlike=("www", *VENDOR_HOSTS), shape=TENANT),
    _sub("keka", "keka.com", path=r"(?i)^/careers", unlike=("www", *VENDOR_HOSTS), shape=TENANT),
    _sub("jobsoid", "jobsoid.com", unlike=("www", *VENDOR_HOSTS), shape=TENANT),
    _seg("recruiterflow", "recruiterflow.com", "www.recruiterflow.com", path=r"^/+([^/]+)/jobs", parts=("p1:l",), unlike=RECRUITERFLOW_PAGES, shape=WORD, reserved=False),
    _sub("homerun", "homerun.co", unlike=("www", *VENDOR_HOSTS), shape=TENANT),
    _sub("isolvedhire", "isolvedhire.com", unlike=_WWW),
    _seg("gem", "jobs.gem.com", parts=("p1:l",)),
    _sub("recruiterbox", "hire.trakstar.com", "recruiterbox.com", unlike=_WWW),
)
PLATFORMS = tuple(dict.fromkeys(r.platform for r in RULES))


def _part(spec: str, rule: Rule, query: Column, host: Column, path: Column) -> Column:
    name, _, case = spec.partition(":") if not spec.startswith("q:") else (spec, "", "")
    if spec.startswith("="):
        return F.lit(spec[1:])
    if spec.startswith("q:"):
        pieces = F.filter(F.split(query, "&"), lambda p: F.lower(F.substring_index(p, "=", 1)) == spec[2:].lower())
        out = F.try_url_decode(F.regexp_extract(F.get(pieces, F.lit(0)), "=(.*)$", 1))
    elif name == "h":
        out = F.regexp_extract(host, rule.host, 1)
    elif name == "h2":
        out = F.regexp_extract(host, rule.host, 2)
    elif name == "h1":
        out = F.substring_index(host, ".", 1)
    else:
        out = F.regexp_extract(path, rule.path, int(name[1:]))
    if case == "d":
        return F.coalesce(F.try_url_decode(F.replace(out, F.lit("+"), F.lit("%2B"))), out)
    return {"l": F.lower, "u": F.upper}.get(case, lambda c: c)(out)


def _parts(url: Column) -> Column:
    """Host without user and port, path and query of a URL."""
    return F.struct(F.regexp_replace(urls.host(url), r"^.*@|:\d+$", "").alias("h"), urls.path(url).alias("p"), urls.query(url).alias("q"))


def _by_rule(rule: Rule, u: Column) -> tuple[Column, Column]:
    """Whether a rule knows a URL of parts u, and its slug then; the host is tested before all else."""
    parts = [_part(spec, rule, u["q"], u["h"], u["p"]) for spec in rule.parts]
    ok = u["h"].rlike(rule.host)
    if rule.path:
        ok = ok & u["p"].rlike(rule.path)
    for p, spec in zip(parts, rule.parts, strict=True):
        if not spec.startswith("="):
            ok = ok & (F.coalesce(p, F.lit("")) != "")
    named = next(p for p, spec in zip(parts, rule.parts, strict=True) if not spec.startswith("="))
    barred = (*(RESERVED if rule.reserved else ()), *rule.unlike)
    if barred:
        ok = ok & ~F.lower(named).isin(*dict.fromkeys(barred))
    for k in rule.real:
        ok = ok & is_real(parts[k])
    slug = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    if rule.shape:
        ok = ok & slug.rlike(rule.shape)
    return ok, slug


#: Any host that some rule knows: one test spares all others.
ANY_HOST = "|".join(f"(?:{h})" for h in dict.fromkeys(r.host for r in RULES))


def _first(rules, u: Column) -> Column:
    """The slug by the first of the rules that knows the URL."""
    out = None
    for r in rules:
        ok, slug = _by_rule(r, u)
        out = F.when(ok, slug) if out is None else out.when(ok, slug)
    return out


def platform_slug(platform: str, url: Column) -> Column:
    """The slug of a URL on one platform: its rules in turn."""
    return urls.let(_parts(url), lambda u: _first([r for r in RULES if r.platform == platform], u))


def first_match(url: Column) -> Column:
    """(ats, slug) of the first platform that knows the URL, NULL if none does."""

    def found(u):
        out = F.when(~u["h"].rlike(ANY_HOST), F.lit(None).cast("struct<ats:string,slug:string>"))
        for r in RULES:
            ok, slug = _by_rule(r, u)
            out = out.when(ok, F.struct(F.lit(r.platform).alias("ats"), slug.alias("slug")))
        return out

    return urls.let(_parts(url), found)


def all_matches(url: Column) -> Column:
    """Array of (ats, slug), one for each platform that knows the URL."""

    def found(u):
        each = [F.struct(F.lit(p).alias("ats"), _first([r for r in RULES if r.platform == p], u).alias("slug")) for p in PLATFORMS]
        return F.when(u["h"].rlike(ANY_HOST), F.filter(F.array(*each), lambda x: x["slug"].isNotNull())).otherwise(F.array().cast("array<struct<ats:string,slug:string>>"))

    return urls.let(_parts(url), found)


def workday_malformed(slug: Column) -> Column:
    """Not company|wdN|site with a site that could be one."""
    p = F.split(slug, r"\|")
    ok = (F.size(p) == 3) & F.get(p, F.lit(0)).rlike(r"^[A-Za-z0-9_-]+$") & F.get(p, F.lit(1)).rlike(r"(?i)^wd\d{1,3}$") & is_real(F.get(p, F.lit(2)))
    return ~F.coalesce(ok, F.lit(False))
