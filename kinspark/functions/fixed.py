"""Fixed values of record preparation: what must be so for right results. Tables read `from=to`, a pair between semicolons."""

from __future__ import annotations


def _pairs(text: str) -> dict[str, str]:
    return dict(p.strip().split("=") for p in text.replace("\n", " ").split(";") if p.strip())


# Patterns of web addresses, of dotted acronyms, of places between figures and three letters or more, and of
# figures in the stead of letters. L: a letter, W: a sign of a word.
L, W = r"[\p{L}\p{No}\p{Nl}]", r"[\p{L}\p{N}_]"
WEB = rf"(?i)(?:https?://)?(?:www\.)?([\p{{L}}\p{{N}}_-]+)\.(?:com|net|org|biz|info|co\.in|in|co|fr|us|io)(?!{W})"
ACRONYM = rf"(?<!{W})(?:{L}\.){{2,}}(?:{L}(?!{W}))?"
GLUED_FIGURES = rf"(?<={L}{{3}})(?=\p{{Nd}})|(?<=\p{{Nd}})(?={L}{{3}})"
FIGURE_LETTERS = {"0": "o", "1": "l", "5": "s", "6": "g"}
FIGURES_INSIDE, FIGURES_LEADING = "01", "0156"
ORDINAL_ENDS = "st|nd|rd|th"

# Words of legal forms, by themselves or mistyped; exceptions; beginnings that tell one.
LEGAL_FORMS = frozenset(
    """inc incorporated llc llp lp ltd limited co corp corporation company plc pllc pc pa dba the and of
    pvt private public opc praivet privet limitd elelpi kampani pablik ltda p td lt pvtltd elaelapi elelapi praivhet
    sarl sas sasu eurl sa sci snc scp scop selarl selas sca gie eirl ei cie compagnie societe et de du des la le les
    gmbh ag bv nv pty srl spa ab oy kg""".split()
)
LEGAL_WORDS = "limited private company corporation incorporated compagnie societe partnership".split()
LEGAL_ANAGRAMS = ("ltd", "pvt")
LEGAL_BEGINNINGS = ("priv", "praiv", "pirai", "limit", "lmit", "incorp", "corpor")
NOT_LEGAL = frozenset("privacy privilege privileged privy limitless corporate companion companions".split())
# Legal forms run together at the edge of a name, in any country and in France.
GLUED_FORMS = "pvtltd privatelimited pvtlimited privateltd coltd ltd pvt llp llc inc corp limited private incorporated corporation company plc".split()
GLUED_FORMS_FRANCE = "sas sasu sarl eurl sci snc selarl scop".split()
# The one name of a legal form, in order of preference; words that belong to none.
LEGAL_NAMES = _pairs("""inc=inc; incorporated=inc; corp=corp; corporation=corp; co=co; company=co; kampani=co; ltd=ltd; limited=ltd;
    limitd=ltd; coltd=ltd; pvt=pvtltd; pvtltd=pvtltd; privatelimited=pvtltd; pvtlimited=pvtltd; privateltd=pvtltd;
    praivetlimitd=pvtltd; privetlimitd=pvtltd; llc=llc; llp=llp; elelpi=llp; elaelapi=llp; elelapi=llp; plc=plc; pllc=pllc;
    sarl=sarl; sas=sas; sasu=sasu; eurl=eurl; sa=sa; sci=sci; snc=snc; gmbh=gmbh""")
LEGAL_FILLERS = frozenset("the and of et de du des la le les dba".split())
HONORIFICS = frozenset("smt shrimati mr mrs kumari sh".split())
INDIA_FORMS = frozenset("pra li".split())
WEB_WORDS = frozenset("www http https".split())
NULL_WORDS = frozenset("null none nan nil undefined".split())

# One form of words with several, in all countries and in one (its own first).
WORD_FORMS = _pairs("""intl=international; svc=services; svcs=services; service=services; mgmt=management; assoc=associates;
    assocs=associates; bros=brothers; ctr=center; centre=center; mfg=manufacturing; natl=national; grp=group; dept=department;
    univ=university; hosp=hospital; mkt=market; sys=systems; tech=technologies; technology=technologies; labs=laboratories;
    lab=laboratories; pharma=pharmaceuticals; ent=enterprises; enterprise=enterprises; entp=enterprises; engg=engineering;
    eng=engineering; sri=shri; shree=shri; shre=shri; sree=shri; doctor=dr; ii=2; iii=3; iv=4;
    street=st; str=st; avenue=ave; av=ave; road=rd; boulevard=blvd; blv=blvd; bd=blvd; drive=dr; lane=ln; court=ct; place=pl;
    square=sq; parkway=pkwy; highway=hwy; expressway=expy; terrace=ter; circle=cir; trail=trl; plaza=plz; building=bldg;
    floor=fl; suite=ste; apartment=apt; room=rm; number=no; num=no; mount=mt; fort=ft; north=n; south=s; east=e; west=w;
    northeast=ne; northwest=nw; southeast=se; southwest=sw;
    first=1st; second=2nd; third=3rd; fourth=4th; fifth=5th; sixth=6th; seventh=7th; eighth=8th; ninth=9th; tenth=10th;
    eleventh=11th; twelfth=12th; thirteenth=13th; fourteenth=14th; fifteenth=15th; sixteenth=16th; seventeenth=17th;
    eighteenth=18th; nineteenth=19th; twentieth=20th; thirtieth=30th; fortieth=40th; fiftieth=50th""")
COUNTRY_FORMS = {
    "india": _pairs("""nr=near; end=and; opp=opposite; oppo=opposite; bhd=behind; nagar=ngr; sector=sec; sect=sec; phase=ph;
        block=blk; extension=extn; ext=extn; dist=district; distt=district; tq=taluk; tal=taluk; taluka=taluk; hno=no;
        industrial=ind; indl=ind; estate=est; cross=crs; layout=lyt; colony=col; chowk=chk; marg=marg; bengaluru=bangalore;
        mumbai=bombay; gurugram=gurgaon; kolkata=calcutta; chennai=madras; puducherry=pondicherry;
        thiruvananthapuram=trivandrum; vadodara=baroda; prayagraj=allahabad; mysuru=mysore; kochi=cochin; belagavi=belgaum;
        mangaluru=mangalore; shimla=simla; pune=poona"""),
    "france": _pairs("""r=rue; st=saint; ste=sainte; bd=boulevard; blvd=boulevard; bld=boulevard; boul=boulevard; av=avenue;
        ave=avenue; imp=impasse; ch=chemin; chem=chemin; pl=place; rte=route; sq=square; fg=faubourg; fbg=faubourg; all=allee;
        qu=quai; crs=cours; res=residence; resid=residence; zi=zone; za=zone; zac=zone; cedex=; bp="""),
}
MAIL_ROUTING = frozenset("cedex bp cs".split())

# Words of addresses by their part.
UNIT_WORDS = frozenset("ste unit apt fl rm bldg flat shop office".split())
STREET_TYPES = frozenset("st ave rd blvd dr ln ct pl sq pkwy hwy expy ter cir trl plz way rue chemin impasse route allee quai cours faubourg passage residence marg".split())
STREET_PARTICLES = frozenset("de du des la le les l d the of n s e w ne nw se sw".split())
HOUSE_SUFFIXES = frozenset("bis ter quater".split())

# States and regions by the phrases that name them.
US_STATES = _pairs("""alabama=al; alaska=ak; arizona=az; arkansas=ar; california=ca; colorado=co; connecticut=ct; delaware=de;
    district of columbia=dc; florida=fl; georgia=ga; hawaii=hi; idaho=id; illinois=il; indiana=in; iowa=ia; kansas=ks;
    kentucky=ky; louisiana=la; maine=me; maryland=md; massachusetts=ma; michigan=mi; minnesota=mn; mississippi=ms; missouri=mo;
    montana=mt; nebraska=ne; nevada=nv; new hampshire=nh; new jersey=nj; new mexico=nm; new york=ny; north carolina=nc;
    north dakota=nd; ohio=oh; oklahoma=ok; oregon=or; pennsylvania=pa; rhode island=ri; south carolina=sc; south dakota=sd;
    tennessee=tn; texas=tx; utah=ut; vermont=vt; virginia=va; washington=wa; west virginia=wv; wisconsin=wi; wyoming=wy;
    puerto rico=pr""")
INDIA_STATES = _pairs("""andhra pradesh=ap; arunachal pradesh=ar; assam=as; bihar=br; chhattisgarh=cg; chattisgarh=cg; goa=ga;
    gujarat=gj; haryana=hr; himachal pradesh=hp; jharkhand=jh; karnataka=ka; kerala=kl; madhya pradesh=mp; maharashtra=mh;
    manipur=mn; meghalaya=ml; mizoram=mz; nagaland=nl; odisha=od; orissa=od; punjab=pb; rajasthan=rj; sikkim=sk;
    tamil nadu=tn; tamilnadu=tn; telangana=ts; tripura=tr; uttar pradesh=up; uttarakhand=uk; uttaranchal=uk; west bengal=wb;
    andaman and nicobar islands=an; chandigarh=ch; dadra and nagar haveli=dn; daman and diu=dd; delhi=dl; new delhi=dl;
    nct of delhi=dl; dilli=dl; jammu and kashmir=jk; jammu kashmir=jk; ladakh=la; lakshadweep=ld; puducherry=py;
    pondicherry=py; maharashtr=mh; karnatak=ka; gujrat=gj; rajasthaan=rj; madhy pradesh=mp; tamil naadu=tn; tamizh naadu=tn;
    pashchim bangal=wb; haryaana=hr; bihaar=br; telangaan=ts""")
FRANCE_REGIONS = _pairs("""hauts de france=hdf; nord=hdf; pas de calais=hdf; somme=hdf; aisne=hdf; oise=hdf; nouvelle aquitaine=naq;
    gironde=naq; landes=naq; pyrenees atlantiques=naq; dordogne=naq; charente maritime=naq; charente=naq; lot et garonne=naq;
    pays de la loire=pdl; loire atlantique=pdl; vendee=pdl; maine et loire=pdl; sarthe=pdl; mayenne=pdl; ile de france=idf;
    paris=idf; hauts de seine=idf; seine saint denis=idf; val de marne=idf; yvelines=idf; essonne=idf; val d oise=idf;
    seine et marne=idf; auvergne rhone alpes=ara; rhone=ara; isere=ara; provence alpes cote d azur=pac; bouches du rhone=pac;
    alpes maritimes=pac; var=pac; occitanie=occ; haute garonne=occ; herault=occ; grand est=ges; bas rhin=ges; haut rhin=ges;
    moselle=ges; bretagne=bre; ille et vilaine=bre; finistere=bre; morbihan=bre; cotes d armor=bre; normandie=nor;
    seine maritime=nor; calvados=nor; centre val de loire=cvl; loiret=cvl; bourgogne franche comte=bfc; cote d or=bfc;
    doubs=bfc; corse=cor""")
STATES = {"us": US_STATES, "usa": US_STATES, "united states": US_STATES, "india": INDIA_STATES, "france": FRANCE_REGIONS}

# Spellings of Indian names brought together; letter groups of the phonetic skeleton, in this order.
INDIA_SPELLINGS = [("ph", "f"), ("oo", "u"), ("ee", "i"), ("x", "ksh"), ("w", "v")]
SKELETON = [("ph", "f"), ("ck", "k"), ("sch", "sk"), ("sh", "x"), ("ch", "x"), ("th", "0"), ("gh", ""), ("kn", "n"), ("wr", "r"), ("q", "k"), ("z", "s"), ("c", "k"), ("v", "f")]

# Latin letters of the Indic scripts by place in a script's block of 128: consonants from 0x15 and from 0x58,
# vowels from 0x04 and from 0x60, vowel signs from 0x3E, at 0x57 and from 0x62, further signs from 0x00.
INDIC_CONSONANTS = {0x15: "k kh g gh n ch chh j jh n t th d dh n t th d dh n n p ph b bh m y r r l l zh v sh sh s h".split(), 0x58: "q kh g z d rh f y".split()}
INDIC_VOWELS = {0x04: "a a aa i ii u uu ri li e e e ai o o o au".split(), 0x60: "ri li".split()}
INDIC_VOWEL_SIGNS = {0x3E: "aa i ii u uu ri ri e e e ai o o o au".split(), 0x57: ["au"], 0x62: "li li".split()}
INDIC_SIGNS = {0x00: "n n n h".split()}
INDIC_NUKTA, INDIC_VIRAMA, INDIC_ZERO, INDIC_STOPS = 0x3C, 0x4D, 0x66, (0x64, 0x65)
#: Blocks whose words lose a last short a, and consonants (ya, ra, va) after which it stays in a conjunct.
SCHWA_BLOCKS, SCHWA_KEPT = (0x0900, 0x0A00, 0x0A80), (0x2F, 0x30, 0x35)

# Characters that a judge of pairs reads, numbered from 3; before a pair stands a 1.
CHARACTERS, PAIR_SIGN = " abcdefghijklmnopqrstuvwxyz0123456789", 1
