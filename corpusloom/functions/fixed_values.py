"""Word lists and lookup tables that results depend on.

Everything here is data, stated as plain text. Nothing is computed from it
beyond splitting the text into entries.
"""

# Language code, then name as published. 185 entries.
# Two codes (Ga, ka) share one name, so counts are summed by name.
_LANGUAGE_NAMES = """
aa Afar
ab Abkhazian
ae Avestan
af Afrikaans
ak Akan
am Amharic
an Aragonese
ar Arabic
as Assamese
av Avaric
ay Aymara
az Azerbaijani
ba Bashkir
be Belarusian
bg Bulgarian
bh Bihari languages
bi Bislama
bm Bambara
bn Bengali
bo Tibetan
br Breton
bs Bosnian
ca Catalan; Valencian
ce Chechen
ch Chamorro
co Corsican
cr Cree
cs Czech
cu Church Slavic; Old Slavonic; Church Slavonic; Old Bulgarian; Old Church Slavonic
cv Chuvash
cy Welsh
da Danish
de German
dv Divehi; Dhivehi; Maldivian
dz Dzongkha
ee Ewe
el Greek, Modern (1453-)
en English
eo Esperanto
es Spanish
et Estonian
eu Basque
fa Persian
ff Fulah
fi Finnish
fj Fijian
fo Faroese
fr French
fy Western Frisian
Ga Georgian
ga Irish
gd Gaelic; Scottish Gaelic
gl Galician
gn Guarani
gu Gujarati
gv Manx
ha Hausa
he Hebrew
hi Hindi
ho Hiri Motu
hr Croatian
ht Haitian; Haitian Creole
hu Hungarian
hy Armenian
hz Herero
ia Interlingua (International Auxiliary Language Association)
id Indonesian
ie Interlingue; Occidental
ig Igbo
ii Sichuan Yi; Nuosu
ik Inupiaq
io Ido
is Icelandic
it Italian
iu Inuktitut
ja Japanese
jv Javanese
ka Georgian
kg Kongo
ki Kikuyu; Gikuyu
kj Kuanyama; Kwanyama
kk Kazakh
kl Kalaallisut; Greenlandic
km Central Khmer
kn Kannada
ko Korean
kr Kanuri
ks Kashmiri
ku Kurdish
kv Komi
kw Cornish
ky Kirghiz; Kyrgyz
la Latin
lb Luxembourgish; Letzeburgesch
lg Ganda
li Limburgan; Limburger; Limburgish
ln Lingala
lo Lao
lt Lithuanian
lu Luba-Katanga
lv Latvian
mg Malagasy
mh Marshallese
Mi Micmac
mi Maori
mk Macedonian
ml Malayalam
mn Mongolian
mr Marathi
ms Malay
mt Maltese
my Burmese
na Nauru
nb Bokmål, Norwegian; Norwegian Bokmål
nd Ndebele, North; North Ndebele
ne Nepali
ng Ndonga
nl Dutch; Flemish
nn Norwegian Nynorsk; Nynorsk, Norwegian
no Norwegian
nr Ndebele, South; South Ndebele
nv Navajo; Navaho
oc Occitan (post 1500)
oj Ojibwa
om Oromo
or Oriya
os Ossetian; Ossetic
pa Punjabi
pi Pali
pl Polish
ps Pushto; Pashto
pt Portuguese
qu Quechua
rm Romansh
rn Rundi
ro Romanian; Moldavian; Moldovan
ru Russian
rw Kinyarwanda
sa Sanskrit
sc Sardinian
sd Sindhi
se Northern Sami
sg Sango
si Sinhala; Sinhalese
sk Slovak
sl Slovenian
sm Samoan
sn Shona
so Somali
sq Albanian
sr Serbian
ss Swati
st Sotho, Southern
su Sundanese
sv Swedish
sw Swahili
ta Tamil
te Telugu
tg Tajik
th Thai
ti Tigrinya
tk Turkmen
tl Tagalog
tn Tswana
to Tonga (Tonga Islands)
tr Turkish
ts Tsonga
tt Tatar
tw Twi
ty Tahitian
ug Uighur; Uyghur
uk Ukrainian
ur Urdu
uz Uzbek
ve Venda
vi Vietnamese
vo Volapük
wa Walloon
wo Wolof
xh Xhosa
yi Yiddish
yo Yoruba
za Zhuang; Chuang
zh Chinese
zu Zulu
"""

# Web-noise words removed from a vocabulary, one per line.
_EXCLUDED_WORDS = """
access
account
add
address
also
apr
april
asp
aug
august
avail
back
best
block
brows
calendar
call
career
cart
chart
class
clear
click
close
code
color
com
comment
confirm
contact
content
copyright
current
custom
date
day
dec
december
design
develop
display
download
edit
email
error
event
feb
feburary
file
files
first
follow
font
forgot
format
free
fri
friday
friend
full
function
game
get
give
great
group
help
high
home
html
http
inc
index
internet
item
jan
january
jul
july
jun
june
last
learn
length
life
like
link
list
live
local
log
login
look
love
mail
main
make
map
mar
march
may
member
membership
mon
monday
month
name
nation
need
net
new
next
nov
november
number
oct
october
offer
one
open
order
org
page
password
person
play
post
power
previous
price
product
public
read
recent
refer
report
request
result
return
review
right
sale
save
search
see
select
sep
september
set
shop
show
sign
site
size
sport
start
state
store
support
system
take
team
term
thread
thu
thursday
time
topic
tue
tuesday
type
unit
use
user
version
view
visit
want
way
web
wed
wednesday
well
work
world
year
"""

# Brand and drug words and phrases of the keyword filter, one
# per line; the tokenizer splits phrases into words.
_FILTER_WORDS = """
JNJ
HEAD-TO-TOE
BABY.com
DESITIN
NATUSAN
BABYCENTER.com
PENATEN
VENDOME
NEUTROGENA
ROGAINE
AVEENO
LUBRIDERM
BAND-AID
BENGAY
SAVLON
NEOSPORIN
CORTAID
DAKTARIN
COMPEED
LISTERINE
REMBRANDT
TYLENOL
SUDAFED
PEPCID
NICORETTE
MOTRIN
IMODIUM
DOLORMIN
BENADRYL
MYLANTA
ZYRTEC
ZYRTEC-D
SPLENDA
BENECOL
LACTAID
VISINE
ACUVUE
AXERT
almotriptan
INVEGA
paliperidone
RISPERDAL
risperidone
LEUSTATIN
cladribine
CONCERTA
methylphenidate
INVEGA SUSTENNA
paliperidone
RISPERDAL CONSTA
risperidone
DURAGESIC
fentanyl
REMINYL
galantamine
RAZADYNE
TOPAMAX
topiramate
XARELTO
rivaroxaban
NATRECOR
nesiritide
REOPRO
abciximab
SIMPONI
golimumab
STELARA
ustekinumab
REMICADE
infliximab
EDURANT
rilpivirine
LEVAQUIN
levofloxacin
ZYTIGA
abiraterone
PREZISTA
darunavir
DOXIL
doxorubicin
SIRTURO
bedaquiline
PROCRIT
epoetin alfa
INVOKANA
canagliflozin
VELCADE
bortezomib
OLYSIO
simeprevir
"""

# The 181 English stop words that Spark ML ships
# (StopWordsRemover.loadDefaultStopWords("english")).
_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more
most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd
she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
"""

LANGUAGE_NAMES = [tuple(line.split(" ", 1)) for line in _LANGUAGE_NAMES.strip().splitlines()]
EXCLUDED_WORDS = _EXCLUDED_WORDS.split()
FILTER_WORD_LINES = _FILTER_WORDS.strip().splitlines()
STOP_WORDS = _STOP_WORDS.split()

# Sizes and thresholds of the clustering job.
VOCABULARY_SIZE = 25_000
MAX_CLUSTERS = 100
KEYWORDS_PER_CLUSTER = 100
LARGEST_CLUSTERS = 100
REPORT_CLUSTERS = 20
MIN_TOKEN_CHARS = 3
MIN_KEYWORD_HITS = 2
WINDOW_APPLIES_ABOVE = 1400
WINDOW_SKIP = 400
WINDOW_CHARS = 1000
TOP_LANGUAGES = 10
