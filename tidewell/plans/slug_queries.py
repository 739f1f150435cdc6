"""Board slugs of literal URLs, one for each platform and its odd spellings at least."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import slugs

_UUID = "0a1b2c3d-0a1b-0a1b-0a1b-0a1b2c3d4e5f"
#: (url, platform, slug): slug NULL where the URL names no board.
EXAMPLES = (
    ("https://boards.greenhouse.io/acme/jobs/1", "greenhouse", "acme"),
    ("https://boards.greenhouse.io/embed/job_board/js?for=acme", "greenhouse", "acme"),
    ("https://boards.greenhouse.io/robots.txt", "greenhouse", None),
    ("https://jobs.lever.co/acme/123", "lever", "acme"),
    ("https://jobs.eu.lever.co/acme", "lever", "acme"),
    ("https://jobs.ashbyhq.com/Acme%20Co/x", "ashby", "Acme Co"),
    ("https://acme.bamboohr.com/jobs/", "bamboohr", "acme"),
    ("https://careers-acme.icims.com/jobs", "icims", "acme"),
    ("https://jobsco.icims.com/jobs", "icims", "jobsco"),
    ("https://acme.wd5.myworkdayjobs.com/en-US/External/job/x", "workday", "acme|wd5|External"),
    ("https://acme.wd1.myworkdayjobs.com/favicon.ico", "workday", None),
    ("https://acme.wd1.myworkdayjobs.com/refreshFacet", "workday", None),
    ("https://ats.rippling.com/en-US/acme/jobs", "rippling", "acme"),
    ("https://ats.rippling.com/acme-careers/jobs", "rippling", "acme-careers"),
    ("https://apply.workable.com/Acme/j/1", "workable", "acme"),
    ("https://acme.workable.com/", "workable", "acme"),
    ("https://acme.recruitee.com/o/x", "recruitee", "acme"),
    ("https://jobs.smartrecruiters.com/AcmeInc/1", "smartrecruiters", "AcmeInc"),
    ("https://acme.taleo.net/careersection/ext/jobsearch.ftl", "taleo", "acme|ext"),
    ("https://acme.fa.us2.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1/jobs", "oracle_cloud_hcm", "acme.fa.us2|CX_1"),
    ("https://sjobs.brassring.com/TGnewUI/Search/Home/Home?partnerid=25&siteid=99", "brassring", "25|99"),
    ("https://acme.teamtailor.com/jobs", "teamtailor", "acme"),
    ("https://acme.breezy.hr/p/1", "breezyhr", "acme"),
    ("https://acme.hrmdirect.com/employment", "hrmdirect", "acme"),
    ("https://acme.softgarden.io/job/1", "softgarden", "acme"),
    ("https://acme.zohorecruit.com.au/jobs", "zoho", "acme"),
    (f"https://recruiting.paylocity.com/recruiting/jobs/All/{_UUID}/Acme", "paylocity", f"{_UUID}|Acme"),
    ("https://acme.jobs.personio.de/", "personio", "acme"),
    ("https://join.com/companies/Acme/1", "joincom", "acme"),
    ("https://acme.eploy.net/", "eploy", "acme"),
    ("https://clientapps.jobadder.com/12/acme/job/1", "jobadder", "12|acme"),
    ("https://jobs.jobvite.com/careers/acme/jobs", "jobvite", "acme"),
    ("https://hire.jobvite.com/CompanyJobs/Careers.aspx?c=qXy", "jobvite", "qXy"),
    (f"https://workforcenow.adp.com/mascsr/default/mdf/recruitment/recruitment.html?cid={_UUID}&ccId=19000101_000001", "adp", f"{_UUID}|19000101_000001"),
    ("https://acme.avature.net/careers", "avature", "acme"),
    ("https://careers.pageuppeople.com/422/cw/en/listing", "pageup", "422|cw"),
    ("https://acme.pinpointhq.com/", "pinpoint", "acme"),
    ("https://careers.flatchr.io/company/Acme/x", "flatchr", "acme"),
    ("https://emp.jobylon.com/companies/77-acme/", "jobylon", "77-acme"),
    ("https://jobs.dayforcehcm.com/en-US/acme/CANDIDATEPORTAL/jobs/1", "dayforce", "acme"),
    ("https://jobs.dayforcehcm.com/en-US/acme/BOARD2/jobs/1", "dayforce", "acme|BOARD2"),
    ("https://acme.getro.com/jobs", "getro", "acme"),
    ("https://acme.csod.com/ux/ats/careersite/4/home", "csod", "acme|4"),
    ("https://acme.csod.com/", "csod", "acme|1"),
    ("https://www.paycomonline.net/v4/ats/web.php/portal/0123456789abcdef0123456789abcdef/career-page", "paycom", "0123456789ABCDEF0123456789ABCDEF"),
    ("https://careers.hireology.com/Acme", "hireology", "acme"),
    ("https://acme.hirehive.com/", "hirehive", "acme"),
    ("https://www.careers-page.com/acme/job/X", "manatal", "acme"),
    ("https://careers.jobscore.com/careers/acme", "jobscore", "acme"),
    ("https://jobs.crelate.com/portal/v2/Acme/x", "crelate", "acme"),
    ("https://www.comeet.com/jobs/Acme/a1.00b/dev/x", "comeet", "acme|A1.00B"),
    ("https://acme.career.emply.com/en", "emply", "acme"),
    ("https://acme.catsone.com/careers/12-general", "cats", "acme|12"),
    ("https://acme.elmotalent.com.au/careers/main/jobs", "elmo", "acme|main"),
    ("https://acme.easyapply.co/", "easyapply", "acme"),
    ("https://acme.careers.hibob.com/jobs", "hibob", "acme"),
    ("https://jobs.deel.com/job-boards/acme", "deel", "acme"),
    ("https://acme.applicantpro.com/jobs/", "applicantpro", "acme"),
    ("https://acme.traffit.com/career/", "traffit", "acme"),
    ("https://api.traffit.com/", "traffit", None),
    ("https://acme.freshteam.com/jobs", "freshteam", "acme"),
    ("https://acme.peopleforce.io/careers", "peopleforce", "acme"),
    ("https://acme.factorial.com/", "factorial", "acme"),
    ("https://app.loxo.co/acme", "loxo", "acme"),
    ("https://acme.careerplug.com/jobs", "careerplug", "acme"),
    ("https://acme.keka.com/careers", "keka", "acme"),
    ("https://acme.jobsoid.com/", "jobsoid", "acme"),
    ("https://recruiterflow.com/acme/jobs", "recruiterflow", "acme"),
    ("https://acme.homerun.co/", "homerun", "acme"),
    ("https://acme.isolvedhire.com/jobs/", "isolvedhire", "acme"),
    ("https://jobs.gem.com/Acme/x", "gem", "acme"),
    ("https://acme.hire.trakstar.com/", "recruiterbox", "acme"),
    ("https://example.com/careers", "greenhouse", None),
)


def slug_rules(spark: SparkSession, d: str) -> DataFrame:
    """Each example's slug on its platform."""
    rows = spark.createDataFrame([(k, u, p) for k, (u, p, _) in enumerate(EXAMPLES)], "k int, url string, platform string")
    found = F.coalesce(*[F.when(F.col("platform") == p, slugs.platform_slug(p, F.col("url"))) for p in dict.fromkeys(p for _, p, _ in EXAMPLES)])
    return rows.select("k", "url", "platform", found.alias("slug"))


_VALUES = ", ".join(f"({k}, '{u}', '{p}', {'null' if s is None else repr(s)})" for k, (u, p, s) in enumerate(EXAMPLES))
SLUGS = f"select cast(k as integer) as k, url, platform, cast(slug as varchar) as slug from (values {_VALUES}) v(k, url, platform, slug)"


def slug_first(spark: SparkSession, d: str) -> DataFrame:
    """The first platform that knows each address of pages or examples."""
    rows = spark.createDataFrame([(u,) for u, _, _ in EXAMPLES], "url string").unionByName(spark.read.parquet(f"{d}/pages.parquet").select("url"))
    # An array of one or none, so that the rules run once for each row.
    return rows.select("url", F.explode(F.array_compact(F.array(slugs.first_match(F.col("url"))))).alias("m")).select("url", "m.ats", "m.slug")


QUERIES = {"slug_rules": (slug_rules, SLUGS), "slug_first": (slug_first, None)}
