"""Input tables for the registered queries, derived from the given tables.

Every text is SQL that Spark and DuckDB both run; `{pages}` and the like stand for the given tables.
Sixteen neighbouring pages make one career site, so sites grow in number with the data:

  0 site root     4 listing without job links   8 job page, with apply link     12 job page, only in feeds
  1 /careers      5 vendor blog post            9 job page, only in the listing 13 sign-in form as job page
  2 listing       6 sign-in link                10 job page in listing and feed 14 nameless page behind a card
  3 card listing  7 other vendor page           11 like 8, only in the feed     15 job page that is gone
"""

from vacancyflow import DEFAULT_PROFILE

VENDOR = DEFAULT_PROFILE.vendor_suffix

_ROLES = """
select page_id, html, page_id % 16 as role, page_id - page_id % 16 as grp,
       concat('https://c', page_id - page_id % 16, '.VENDOR') as site,
       regexp_extract(html, '<title>([^<]*)</title>', 1) as title
from {pages}
"""

# Every other listing begins with more links than the limit of links allows.
_MANY_LINKS = "".join(f'<li><a href="/careers/SearchJobs/more/{n}">More {n}</a></li>' for n in range(110))
_LISTING_BODY = """concat(
  '<html><head><title>Open jobs</title></head><body><nav><a href="/careers/Login">Sign in</a>',
  '<a href="', site, '/careers/SearchJobs/">This page</a><a href="SearchJobs?page=2">Next</a><a href="  ">Blank</a>',
  '<a name="x">No link</a><a href="https://other.example.com/careers/JobDetail/T/1">Elsewhere</a></nav><ul>',
  case when grp % 32 = 0 then '{MORE_LINKS}' else '' end,
  '<li><a href="/careers/JobDetail/T/', grp + 9, '">Job <b>', grp + 9, '</b></a></li>',
  '<li><a class="title" href="JobDetail/T/', grp + 10, '"> Job ', grp + 10, ' </a></li>',
  '<li><a href="/careers/JobDetail/T/', grp + 9, '">Once more</a></li>',
  '<li><a href="//c', grp, '.VENDOR/careers/JobDetail/T/', grp + 13, '">', repeat('long ', 90), '</a></li>',
  '<li><a href="HTTPS://C', grp, '.VENDOR/careers/JobDetail/Big"></a></li>',
  '<li><a href="/careers/JobDetail/T/', grp + 15, '">Gone</a></li>',
  '<li><a href="/careers/JobDetail/T/', grp + 8, '">Known</a></li>',
  '<li><a href="/careers/team/777/view">Digits</a></li><li><a href="?jobId=', grp, '">By number</a></li>',
  '<li><a href="/careers/SearchJobs/extra">Deep search</a></li><li><a href="/about/us">About us</a></li>',
  '</ul></body></html>')""".replace("{MORE_LINKS}", _MANY_LINKS)

_CARDS_BODY = """concat(
  '<html><body><div class="job-card wide"><h3>Card ', grp, '</h3><a href="/about">About</a>',
  '<a href="/en_GB/careers/SearchJobs">Open</a></div>',
  '<div class="search-result"><a href="/en_GB/careers/SearchJobs">Same link</a></div>',
  '<p data-job-id="9"><a href="/about">No job</a></p></body></html>')"""

_APPLY = """concat('<div class="job-location">City ', page_id % 7, '</div><span class="posted-date">2024-01-',
  10 + page_id % 20, '</span><a href="', case when role = 8 then concat('/careers/apply/', grp) else '../apply?j=1' end,
  '">Apply</a><article>')"""

_WEB = f"""
select page_id, role, grp, site, title,
  case role
    when 0 then site
    when 1 then concat(site, '/careers')
    when 2 then concat(site, '/careers/SearchJobs')
    when 3 then concat(site, '/en_US/careers/SearchJobs')
    when 4 then concat(site, '/global/SearchJobs')
    when 5 then concat('https://www.VENDOR/blogs/', page_id, '/')
    when 6 then concat(site, '/careers/Login?jobId=', page_id)
    when 7 then concat('https://www.VENDOR/x/', page_id)
    when 14 then concat(site, '/en_GB/careers/SearchJobs')
    else concat(site, '/careers/JobDetail/T/', page_id) end as url,
  case when role = 15 or (role = 1 and grp % 5 = 4) then 404 else 200 end as status,
  case role
    when 2 then {_LISTING_BODY}
    when 3 then {_CARDS_BODY}
    when 7 then concat('<html><head><title> ', title, ' </title></head><body><p>Page ', page_id, '</p><p>', case when page_id % 48 = 7 then repeat('many words ', 2000) else 'end' end)
    when 8 then replace(html, '<article>', {_APPLY})
    when 11 then replace(html, '<article>', {_APPLY})
    when 12 then replace(html, '<article>', concat('<p class="location">Town ', page_id % 5, '</p><article>'))
    when 13 then '<html><body><h1>Welcome</h1><div class="job-description">Forgot your password? Use the login form.</div></body></html>'
    when 14 then concat('<html><body><div class="description">Role ', page_id, ' starts soon.</div><div class="content">Second text</div></body></html>')
    else html end as body
from ({_ROLES}) roles
"""

_ITEM = (
    "'<item><title>', title, '</title><link>', site, '/careers/JobDetail/T/', grp + {n}, "
    "'</link><guid>job-', grp + {n}, '</guid><pubDate>Mon, 0{d} Jan 2024</pubDate>"
    "<description>{intro}<![CDATA[<p>About job ', grp + {n}, '</p>', {more}, ']]></description></item>',"
)
_INTRO = 'Read <i title="now">on <b>or </b></i>off: '
_NO_MORE = "''"
_GUID_ITEM = "'<item><title>By <b>guid</b>, not <i>link</i></title><link></link><guid>//c', grp, '.VENDOR/careers/JobDetail/G/', grp, '</guid></item>',"
_OTHER_ITEMS = (
    "'<item><title>News</title><link>https://www.VENDOR/blogs/', grp, '/</link></item>"
    "<item><title>Our test-cookies story</title><link>', site, '/careers/story</link></item>"
    "<item><title>Sign in</title><link>', site, '/careers/Login?jobId=', grp, '</link></item>"
    "<item><title>No link at all</title></item><item><link>', site, '/careers/untitled/', grp, '</link></item>',"
)

# Feed documents: the root's /rss has no posting, /careers/rss has some but is broken on every third site,
# /jobs/feed is an RDF document.
_FEEDS = f"""
select page_id, role, grp, site,
  concat(site, case role when 0 then '/rss' when 1 then '/careers/rss' else '/jobs/feed' end) as url,
  case when role = 1 and grp % 7 = 6 then 404 else 200 end as status,
  case
    when role = 0 then concat('<rss><channel><title>Blog</title><item><title>Post</title><link>https://www.VENDOR/blogs/', page_id,
      '/</link></item><item><title>', title, '</title><link>', site, '/news/', page_id, '</link></item></channel></rss>')
    when role = 1 then concat('<rss xmlns:atom="a"><channel><atom:link href="', site, '/careers/rss" rel="self"/>',
      {_ITEM.format(n=10, d=1, intro="", more=_NO_MORE)} {_ITEM.format(n=11, d=2, intro=_INTRO, more=_NO_MORE)}
      {_ITEM.format(n=12, d=3, intro="", more="case when grp % 64 = 0 then repeat('more words ', 3000) else '' end")}
      {_GUID_ITEM} {_OTHER_ITEMS} case when grp % 3 = 1 then '<item><title>cut' else '</channel></rss>' end)
    else concat('<rdf:RDF xmlns:rdf="r"><channel><title>Jobs</title></channel>',
      {_ITEM.format(n=12, d=4, intro="", more=_NO_MORE)} '</rdf:RDF>') end as body
from ({_ROLES}) roles where role in (0, 1, 2)
"""


def _vendor(sql: str) -> str:
    return sql.replace("VENDOR", VENDOR)


WEB = _vendor(_WEB)
FEEDS = _vendor(_FEEDS)
_FETCHED_ONCE = f"select page_id, url, status, body from ({WEB}) web union all select page_id, url, status, body from ({FEEDS}) feeds"
# Some pages were fetched before, with another body, and answered although they are gone now; one was asked for
# again and failed, then read once more.
FETCHED = f"""
select url, status, body, 5 as fetched_at from ({_FETCHED_ONCE}) last_fetch union all
select url, 200 as status, replace(body, 'a', 'b') as body, 2 as fetched_at from ({_FETCHED_ONCE}) first_fetch where page_id % 3 = 0 or status = 404 union all
select url, 503 as status, 'busy' as body, 4 as fetched_at from ({_FETCHED_ONCE}) failed_fetch where page_id % 7 = 0
"""
# The same with more than a hundred job links on every listing.
LONG_FETCHED = f"select url, status, fetched_at, replace(body, '</ul></body>', '{_MANY_LINKS}</ul></body>') as body from ({FETCHED}) short"
LINKS = f"select page_id as link_seq, url from ({WEB}) web where role <= 8"

# A link list with every class of link and many repeats.
REPEATED_LINKS = _vendor(
    """
select page_id as link_seq, concat('https://', case when page_id % 8 = 7 then 'www.VENDOR'
       else concat('c', page_id % 40, '.VENDOR') end, case page_id % 8
    when 0 then '' when 1 then '/careers' when 2 then '/careers/SearchJobs' when 3 then '/en_US/careers/SearchJobs'
    when 4 then concat('/careers/JobDetail/T/', page_id) when 5 then concat('/blogs/', page_id, '/')
    when 6 then concat('/careers/Login?jobId=', page_id) else concat('/x/', page_id) end) as url
from {pages}
"""
)

# Lines of three link files, with blanks, comments, padding, other schemes and repeats.
LINK_LINES = """
select cast(page_id % 3 as int) as source, page_id as line, case page_id % 11
    when 0 then '' when 1 then concat('# ', url) when 2 then concat('ftp://', page_id) when 3 then concat('  ', url, '  ')
    when 4 then concat('HTTP://', page_id) when 5 then concat('https://h', page_id % 9, '.example.com/jobs')
    else url end as value
from {pages}
"""

CERTIFICATES = _vendor(
    """
select page_id, concat('*.c', page_id % 50, '.VENDOR', chr(10), case page_id % 13
    when 0 then 'mail.VENDOR' when 1 then concat('QATAR', page_id % 3, '.VENDOR ') when 2 then 'notVENDOR'
    when 3 then concat('www.example', page_id, '.com') when 4 then 'careers.uat.VENDOR' when 5 then ''
    else concat('Site', page_id, '.VENDOR') end) as name_value
from {pages}
"""
)

SEARCH_RESULTS = _vendor(
    """
select cast(page_id % 5 as int) as nth, page_id as rank, case page_id % 9
    when 0 then '' when 1 then concat('https://S', page_id % 20, '.VENDOR/careers?x=1')
    when 2 then concat('http://s', page_id % 20, '.VENDOR:8080/') when 3 then concat('www.VENDOR/', page_id)
    when 4 then concat('https://user@VENDOR/jobs#', page_id) else url end as href
from {pages}
"""
)

# Every page URL as a base with one of the forms a link can have.
HREFS = """
select page_id, url, case page_id % 12 when 0 then '/p' when 1 then 'x/y' when 2 then '../up' when 3 then './here'
    when 4 then '?q=1' when 5 then '#frag' when 6 then '//other.example.org' when 7 then 'https://abs.example.org/a/../b'
    when 8 then 'mailto:a@b' when 9 then '/a/./b/../c' when 10 then ' /sp?#' else '' end as href
from {pages}
"""

# Rows for the acceptance rules, around the limits of the sign-in rules.
ACCEPTANCE_ROWS = _vendor(
    """
select page_id, concat('https://', case page_id % 4 when 0 then 'VENDOR' when 1 then 'www.VENDOR'
    when 2 then concat('c', page_id % 40, '.VENDOR') else 'jobs.example.com' end, case page_id % 9
    when 0 then '/careers/1' when 1 then '/blogs/1/' when 2 then '/Blogs/1/' when 3 then '/Careers/Login'
    when 4 then '/x/jobs' when 5 then '/ctscareers/x' when 6 then concat('/careers/hr-trends/', page_id)
    when 7 then '/SearchJobs/a' else '/about' end) as application_url,
  case page_id % 6 when 0 then 'Test-Cookies video' when 1 then 'Blog /blog/ post' else concat('Job ', page_id) end as job_title,
  case page_id % 7
    when 0 then concat('Forgot your password? login ', repeat('x', 560 + page_id % 25))
    when 1 then concat('Already registered? Login with password ', repeat('y', 450 + page_id % 25))
    when 2 then ' Your password must be long' when 3 then '' else concat('We hire. ', page_id) end as job_description
from {pages}
"""
)

# Job rows at volume: repeated keys, one of them with a third of all rows.
EVENT_JOBS = """
select event_id, concat('s', case when event_id % 3 = 0 then 0 else user_id % 50 end) as source_site,
  concat('https://e/careers/', case when event_id % 3 = 0 then 0 else user_id % 500 end) as application_url,
  concat(event_type, ' ', event_id) as job_title, props as job_description
from {events}
"""

# Enrichment at volume: documents as job rows of two passes; source and language make the key.
DOCUMENT_JOBS = """
select doc_id, case when doc_id % 4 = 0 then 1 else 3 end as pass, source as source_site,
  concat('https://d/', case when doc_id % 10 = 9 then 'login/' else 'careers/' end, lang, '/', doc_id % 23) as application_url,
  concat('Doc ', doc_id) as job_title,
  case when doc_id % 6 = 1 then concat('Your password must ', text) else text end as job_description,
  case when doc_id % 3 = 0 then concat('City ', doc_id) when doc_id % 3 = 1 then '' end as location,
  case when doc_id % 5 = 0 then concat('2024-', doc_id) end as date_posted
from {documents}
"""
